"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard owns many places on a ring of cells; a row hashes to a cell and belongs to the next place clockwise. A
shard accepts rows up to its capacity and what overflows continues clockwise to the next place with room. Capacities
differ by one row at most and add up to the number of rows, so every shard ends exactly full.

Rows of a cell are numbered by their hash, and rows move from place to place in whole ranges of these numbers, so the
flow follows from the counts per cell alone. The number of cells is a parameter, whatever the input; the counts and the
flow are the only things that pass the driver. Rows then find their range by a join with the flow, which has a fixed
number of rows as well. Only (id, size, checksum) of a row is shuffled, never its text.

Defined cases: a null text has no bytes (size is the overhead alone) and checksum 0; a null id hashes like a value of
its own; rows that agree in id and text are numbered in no particular order, which shows in nothing; repeated ids may
fill a cell with any share of all rows, since cells are split into slices before rows are numbered; an empty table gives
an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import json
from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

# Cells of the ring; each holds a small share of all rows.
CELLS = 1 << 14
# Slices of a cell that are numbered apart.
SLICES = 16
PLAN = "cell: int, part: int, first: bigint, ranges: array<struct<a: bigint, b: bigint, shard: int, slot: bigint>>"


def ring_places(shards: int, replicas: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes, clockwise. A shard's places don't depend on the number of shards."""
    found = []
    for shard in range(shards):
        for r in range(replicas):
            digest = hashlib.sha256(f"{shard}/{r}".encode()).digest()
            found.append((int.from_bytes(digest[:4], "big") % CELLS, int.from_bytes(digest[4:8], "big"), shard))
    return [(cell, shard) for cell, _, shard in sorted(found)]


def place_of_cell(places: list[tuple[int, int]], cell: int) -> int:
    """Number of the first place at or after a cell."""
    return bisect.bisect_left(places, (cell, -1)) % len(places)


def flow(counts: dict[int, int], shards: int, replicas: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Where the rows of each cell end: (cell, from, to, shard, slot of the first).

    ``counts`` has the rows per cell. Cells send their rows clockwise in rounds: in each, every cell with rows left asks
    the next place, which takes as many as its shard has room for.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    places = ring_places(shards, replicas)
    waiting = deque((cell, place_of_cell(places, cell), 0) for cell in sorted(counts))
    while waiting:
        cell, place, done = waiting.popleft()
        shard = places[place][1]
        taken = min(room[shard] - filled[shard], counts[cell] - done)
        if taken:
            yield cell, done, done + taken, shard, filled[shard]
            filled[shard] += taken
            done += taken
        if done < counts[cell]:
            waiting.append((cell, (place + 1) % len(places), done))


def assign(
    df: DataFrame, shards: int = 40, replicas: int = 64, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``df``."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    rows = materialize(
        rows.withColumn("cell", F.pmod(key, F.lit(CELLS)).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", F.monotonically_increasing_id()), F.lit(SLICES)).cast("int"))
    )
    slices = rows.groupBy("cell", "part").agg(F.count("*").alias("n"))
    counts: dict[int, int] = {}
    before: list[tuple[int, int, int]] = []
    for r in sorted(slices.collect()):  # CELLS * SLICES rows at most
        before.append((r["cell"], r["part"], counts.get(r["cell"], 0)))
        counts[r["cell"]] = counts.get(r["cell"], 0) + r["n"]
    ranges: dict[int, list] = {}
    for cell, start, end, shard, slot in flow(counts, shards, replicas):
        ranges.setdefault(cell, []).append((start, end, shard, slot))
    plan = _plan_table(spark, [(c, p, start, ranges[c]) for c, p, start in before])
    numbered = rows.withColumn("nth", F.row_number().over(Window.partitionBy("cell", "part").orderBy("text_crc32", "doc_id")) - 1)
    at = F.col("first") + F.col("nth")
    own = F.filter("ranges", lambda r: (r["a"] <= at) & (at < r["b"]))[0]
    return (
        numbered.join(F.broadcast(plan), ["cell", "part"])  # CELLS * SLICES rows at most
        .withColumn("own", own)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("own.shard").alias("shard"),
            (F.col("own.slot") + at - F.col("own.a")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _plan_table(spark: SparkSession, rows: list) -> DataFrame:
    """The flow as a table, through JSON so that no Python objects reach the executors."""
    names, inner = ("cell", "part", "first", "ranges"), ("a", "b", "shard", "slot")
    values = [dict(zip(names, (*row[:3], [dict(zip(inner, r)) for r in row[3]]))) for row in rows]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{PLAN}>>")))
