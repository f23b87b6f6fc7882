"""Lines that repeat across documents, found with two Bloom filters.

1. Every task adds the distinct line hashes of each document to two filters of a fixed size, "seen" and "seen
   again". Filters are cut into segments, shuffled by segment and merged while they stream, so no task holds more
   than one pair of segments: a bit set by two tasks counts as seen again. Nothing is lost: a line of two documents
   always has all its bits in the second filter.
2. The second filter, of a fixed size, goes to every task. Only lines that it suspects leave the scan, as (key, number
   of documents), summed within the batch before the shuffle. Their exact counts settle them.
3. Lines whose key is in at least ``min_docs`` documents are dropped, or all but the first occurrence of each. Confirmed
   keys are broadcast while their bytes are under a bound; beyond it they are joined to the suspected lines.

More lines than the filters were made for only raise the share of suspected lines, never change the result.

A key is the line without surrounding ASCII white space, in ASCII lower case. Defined cases: a null or empty text is
one empty line; keys shorter than ``min_chars`` always stay; a document that loses all its lines becomes empty; repeated
rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, text_batches

SEGMENTS = 128


@dataclass(frozen=True)
class Rule:
    min_docs: int = 10
    min_chars: int = 1
    #: Keep the first occurrence (smallest document id, then earliest line) of a dropped key.
    keep_first: bool = False
    #: Bits of each filter; both are sent to every task.
    filter_bits: int = 1 << 27
    #: Bytes of confirmed keys that may be broadcast.
    broadcast_bytes: int = 32 << 20


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions per hash."""
    return np.stack([hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) * np.uint64(0x9E3779B1) & np.uint64(bits - 1)])


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((filter_[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(filter_, flat >> 3, np.uint8(1) << (flat & 7).astype(np.uint8))


def _keys(text: str, least: int) -> set[bytes]:
    found = set(map(line_key, text.encode().split(b"\n")))
    return {k for k in found if len(k) >= least and (least <= 1 or len(k.decode()) >= least)}


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def repeated_filter(texts: DataFrame, rule: Rule) -> np.ndarray:
    """The second filter, merged over all documents."""
    bits, part = rule.filter_bits, rule.filter_bits // 8 // SEGMENTS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for _, found in text_batches(batches):
            keys = [k for t in found for k in _keys(t, rule.min_chars)]
            if not keys:
                continue
            hashes, counts = np.unique(_hashes(keys), return_counts=True)
            places = _positions(hashes, bits).astype(np.int64)
            repeat = (counts > 1) | _has(seen, places)
            _set(again, places[:, repeat])
            _set(seen, places)
        for s in range(SEGMENTS):
            one, two = seen[s * part : (s + 1) * part], again[s * part : (s + 1) * part]
            if one.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([zlib.compress(one, 1)]), pa.array([zlib.compress(two, 1)])],
                    ["segment", "seen", "again"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by segment."""
        at, seen, again = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zlib.compress(again, 1)])], ["segment", "again"])

        for batch in batches:
            for s, one, two in zip(*(batch.column(c).to_pylist() for c in ("segment", "seen", "again"))):
                one, two = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (one, two))
                if s != at:
                    if at is not None:
                        yield done()
                    at, seen, again = s, one.copy(), two.copy()
                else:
                    again |= two | (seen & one)
                    seen |= one
        if at is not None:
            yield done()

    parts = (
        texts.select("text")
        .mapInArrow(build, "segment int, seen binary, again binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(merge, "segment int, again binary")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.collect():  # SEGMENTS rows of a fixed size
        out[row["segment"] * part : (row["segment"] + 1) * part] = np.frombuffer(zlib.decompress(row["again"]), np.uint8)
    return out


def repeated_keys(texts: DataFrame, rule: Rule, suspects) -> DataFrame:
    """(key, n_docs) of all keys in at least ``min_docs`` documents; ``suspects`` is the broadcast second filter."""
    bits = rule.filter_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = suspects.value
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["key", "n"])
            held.clear()
            return rows

        for _, found in text_batches(batches):
            keys = [k for t in found for k in _keys(t, rule.min_chars)]
            if keys:
                mark = _has(filter_, _positions(_hashes(keys), bits).astype(np.int64))
                held.update(k for k, m in zip(keys, mark.tolist()) if m)
            if len(held) > 100_000:
                yield out()
        if held:
            yield out()

    return (
        texts.select("text")
        .mapInArrow(count, "key binary, n bigint")
        .groupBy("key")
        .agg(F.sum("n").alias("n_docs"))
        .filter(F.col("n_docs") >= rule.min_docs)
    )


def drop_lines(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with the rewritten text, and ``n_lines`` and ``n_dropped`` beside it.

    The counts replace columns of these names.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    texts = df.select(F.col(text_col).cast("string").alias("text"))
    suspects = spark.sparkContext.broadcast(repeated_filter(texts, rule))
    keys = materialize(repeated_keys(texts, rule, suspects))
    keys_bytes = keys.agg(F.coalesce(F.sum(F.length("key") + 64), F.lit(0))).first()[0]
    if keys_bytes <= rule.broadcast_bytes and not rule.keep_first:
        known = spark.sparkContext.broadcast(frozenset(bytes(r["key"]) for r in keys.select("key").collect()))
        return _drop_known(df, known, text_col)
    return _drop_joined(df, keys, rule, suspects, id_col, text_col)


def _with_counts(df: DataFrame, text_col: str):
    """Schema of ``df`` with the two counts at the end, and the columns that stay."""
    stay = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    kept = df.select(*stay)
    return kept, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", n_lines bigint, n_dropped bigint"


def _replaced(batch: pa.RecordBatch, text_col: str, texts: list, n: list[int], dropped: list[int]) -> pa.RecordBatch:
    columns = [pa.array(texts, pa.string()) if name == text_col else batch.column(i) for i, name in enumerate(batch.schema.names)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(n, pa.int64()), pa.array(dropped, pa.int64())], [*batch.schema.names, "n_lines", "n_dropped"]
    )


def _drop_known(df: DataFrame, known, text_col: str) -> DataFrame:
    kept, schema = _with_counts(df, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = known.value
        for batch, found in text_batches(batches, text_col):
            texts, n, dropped = [], [], []
            for text in found:
                lines = text.encode().split(b"\n")
                stay = [line for line in lines if line_key(line) not in keys]
                n.append(len(lines))
                dropped.append(len(lines) - len(stay))
                texts.append(b"\n".join(stay).decode())
            yield _replaced(batch, text_col, texts, n, dropped)

    return kept.mapInArrow(run, schema)


def _free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _drop_joined(df: DataFrame, keys: DataFrame, rule: Rule, suspects, id_col: str, text_col: str) -> DataFrame:
    """The way for many confirmed keys, and for keeping first occurrences.

    Rows get an id by their place in a stored copy; suspected lines are joined to the keys, and the numbers of the
    lines to drop go back to their rows. A null id is the smallest when first occurrences are kept.
    """
    bits = rule.filter_bits
    kept, schema = _with_counts(df, text_col)
    own_row, own_drops = _free_name(kept, "_row"), _free_name(kept, "_drops")
    stored = materialize(kept.withColumn(own_row, F.monotonically_increasing_id()))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = suspects.value
        for batch, found in text_batches(batches):
            keys_, rows, docs, places = [], [], [], []
            for row, doc, text in zip(batch.column("_row").to_pylist(), batch.column("doc").to_pylist(), found):
                for at, line in enumerate(text.encode().split(b"\n")):
                    keys_.append(line_key(line))
                    rows.append(row)
                    docs.append(doc)
                    places.append(at)
            mark = _has(filter_, _positions(_hashes(keys_), bits).astype(np.int64)) if keys_ else []
            pick = np.flatnonzero(mark)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys_[i] for i in pick], pa.binary()),
                    pa.array([rows[i] for i in pick], pa.int64()),
                    pa.array([docs[i] for i in pick], pa.int64()),
                    pa.array([places[i] for i in pick], pa.int32()),
                ],
                ["key", "row", "doc", "place"],
            )

    source = stored.select(F.col(own_row).alias("_row"), F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text"))
    found = source.mapInArrow(lines, "key binary, row bigint, doc bigint, place int").join(keys, "key")
    if rule.keep_first:
        found = materialize(found)
        first = found.groupBy("key").agg(F.min(F.struct("doc", "row", "place")).alias("first"))
        found = found.join(first, "key").filter(~F.struct("doc", "row", "place").eqNullSafe(F.col("first")))
    drops = found.groupBy(F.col("row").alias(own_row)).agg(F.sort_array(F.collect_list("place")).alias(own_drops))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in text_batches(batches, text_col):
            texts, n, dropped = [], [], []
            for text, places in zip(found, batch.column(own_drops).to_pylist()):
                all_lines, gone = text.split("\n"), set(places or ())
                n.append(len(all_lines))
                dropped.append(len(gone))
                texts.append("\n".join(line for i, line in enumerate(all_lines) if i not in gone))
            yield _replaced(batch.drop_columns([own_drops]), text_col, texts, n, dropped)

    joined = stored.join(drops, own_row, "left").select(*kept.columns, own_drops)
    return joined.mapInArrow(run, schema)
