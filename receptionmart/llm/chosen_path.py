"""Near-duplicate join on word shingles by chosen paths.

A text is the set of its shingles of ``words`` words. Texts with equal sets are one class from the start. In every run
a set chooses a few of its members, by hashes that all sets share, and goes to the bucket of each: two sets choose a
shared member together. A bucket of up to ``bucket`` sets is compared by brute force; a larger one is split again by
further chosen members, the path, until it is small, ``depth`` is reached, or a split hardly parts it, since then its
sets are alike. Pairs of similarity 0.8 meet in one run at depth 1 with a probability of 0.79 and at depth 3 of 0.68
(with a fan-out of 2), so eight runs miss 4 in a million and 1 in ten thousand.

Buckets with the same members are compared once. Large buckets are cut into chunks and every two chunks meet in one
task, which holds two chunks at most. A pair is counted only in the first bucket that its sets share, so counts are
exact without a list of pairs: tasks return a count and a nearest root per set, never pairs. Buckets are compared twice:
first on sketches of 128 bytes, where a pair stays open from an estimate of ``sketch_least`` on (five standard
deviations below 0.8), then only sets with an open partner are read and compared exactly. Longer paths and sets are
computed from the texts again, which costs a scan but never shuffles sets that don't matter. Classes are the connected
components of the links, found by star contraction of the roots, with one small stored table per round.

Shingle hashes have 32 bits within a set and sets are told apart by 128 bits.

Defined cases: a text of fewer words is one shingle of all its words; texts without words (null, empty) equal each other
and nothing else; a null id is kept and names no class (class_id is the smallest other id, or null); repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_batches, materialize, runs_of, semi_join, small_enough, text_batches


@dataclass(frozen=True)
class Join:
    words: int = 5
    similarity: float = 0.8
    runs: int = 8
    fan_out: float = 2.0
    bucket: int = 200
    depth: int = 3
    #: Sets of a chunk of a large bucket.
    chunk: int = 2048
    #: A split that leaves a bucket with more than this share of its parent has not parted it.
    alike: float = 0.5
    sketch_least: float = 0.6


# Stands for a null id while rows are joined, larger than any other.
NO_ID = 2**63 - 1
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text. Words are what stands between ASCII white space, in lower case."""
    words = text.lower().encode().split()
    if not words:
        return np.zeros(0, np.uint32)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    if n < 1:
        n, width = 1, len(words)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = _mix(out * _M1 + h[k : k + n])
    return np.unique((out >> np.uint64(32)).astype(np.uint32))


def _chosen(members: np.ndarray, paths: np.ndarray, fan_out: float) -> tuple[np.ndarray, np.ndarray]:
    """(path number, node) of the members that a set chooses below each of some paths."""
    drawn = _mix(members.astype(np.uint64)[None, :] * _M1 + paths[:, None])
    limit = min(fan_out / len(members), 1.0) * 2**32 if len(members) else 0
    path, member = np.nonzero((drawn >> np.uint64(32)).astype(float) < limit)
    return path, _mix(drawn[path, member] + _M2).view(np.int64)


def _sketch(members: np.ndarray) -> bytes:
    """For each of 128 ranges of the hash values one byte of the smallest member, 0 where there is none."""
    out = np.zeros(128, np.uint8)
    if len(members):
        order = np.sort(_mix(members.astype(np.uint64) * _M1) >> np.uint64(32))
        place = (order >> np.uint64(25)).astype(np.int64)
        first = np.r_[True, place[1:] != place[:-1]]
        out[place[first]] = (order[first] % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def _seeds(p: Join) -> np.ndarray:
    return _mix(np.arange(1, p.runs + 1, dtype=np.uint64) * _M1)


def _summary(p: Join):
    seeds = _seeds(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            keys, sketches, nodes = [], [], []
            for t in texts:
                own = shingles(t, p.words)
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                sketches.append(_sketch(own))
                nodes.append(np.unique(_chosen(own, seeds, p.fan_out)[1]) if len(own) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))],
                ["id", "key", "sketch", "nodes"],
            )

    return run


def _sets(p: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_batches(batches):
            own = [shingles(t, p.words).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in own], pa.binary()), pa.array(own, pa.binary())], ["key", "members"])

    return run


def _paths(p: Join, depth: int, parents):
    """(key, parent, node) of all paths of a length; ``parents`` (broadcast, or None) are those that matter."""
    seeds = _seeds(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = parents.value if parents is not None else None
        for _, texts in text_batches(batches):
            keys, above, below = [], [], []
            for t in texts:
                own = shingles(t, p.words)
                nodes = seeds
                for _ in range(depth):
                    before = nodes.view(np.int64)
                    path, found = _chosen(own, nodes, p.fan_out)
                    nodes, first = np.unique(found, return_index=True)
                    before, nodes = before[path[first]], nodes.view(np.uint64)
                pick = np.isin(before, wanted) if wanted is not None else np.ones(len(before), bool)
                keys += [xxhash.xxh3_128_digest(own.tobytes())] * int(pick.sum())
                above.append(before[pick])
                below.append(nodes.view(np.int64)[pick])
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(np.concatenate(above)), pa.array(np.concatenate(below))], ["key", "parent", "node"]
                )

    return run


def similar(left: list[np.ndarray], right: list[np.ndarray], least: float, wanted: np.ndarray) -> np.ndarray:
    """Which ``wanted`` pairs of sets have a similarity of ``least`` or more; exact for the given hashes."""
    a, b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    small, large = np.minimum(a[:, None], b[None, :]), np.maximum(a[:, None], b[None, :])
    open_ = wanted & (small >= least * large)
    out = np.zeros_like(open_)
    rows, columns = np.nonzero(open_)
    if not len(rows):
        return out
    use_a, use_b = np.unique(rows), np.unique(columns)
    if len(rows) <= 64:
        for i, j in zip(rows, columns):
            both = len(np.intersect1d(left[i], right[j], assume_unique=True))
            out[i, j] = both >= least * (a[i] + b[j] - both) - 1e-9
        return out
    # Members of both sides become columns of 0 and 1, some thousands at a time.
    all_a, all_b = (np.concatenate([s[i] for i in use]) for s, use in ((left, use_a), (right, use_b)))
    of_a, of_b = (np.repeat(np.arange(len(use)), [len(s[i]) for i in use]) for s, use in ((left, use_a), (right, use_b)))
    shared = np.intersect1d(all_a, all_b)
    both = np.zeros((len(use_a), len(use_b)), np.float32)
    at_a, at_b = np.searchsorted(shared, all_a), np.searchsorted(shared, all_b)
    ok_a = (at_a < len(shared)) & (shared[np.minimum(at_a, len(shared) - 1)] == all_a) if len(shared) else np.zeros(len(all_a), bool)
    ok_b = (at_b < len(shared)) & (shared[np.minimum(at_b, len(shared) - 1)] == all_b) if len(shared) else np.zeros(len(all_b), bool)
    of_a, at_a, of_b, at_b = of_a[ok_a], at_a[ok_a], of_b[ok_b], at_b[ok_b]
    for start in range(0, len(shared), 4096):
        x, y = (np.zeros((n, min(4096, len(shared) - start)), np.float32) for n in (len(use_a), len(use_b)))
        for m, of, at in ((x, of_a, at_a), (y, of_b, at_b)):
            pick = (at >= start) & (at < start + 4096)
            m[of[pick], at[pick] - start] = 1
        both += x @ y.T
    union = a[use_a][:, None] + b[use_b][None, :] - both
    out[np.ix_(use_a, use_b)] = both >= least * union - 1e-6
    return out & open_


BLOCK = "key binary, node bigint, own int, low int, high int, copies bigint, shared array<bigint>"
LINKS = "key binary, text_links bigint, links bigint, root binary"


#: Buckets that are marked at a time, which bounds the marks of a block.
MARKS = 1024


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of either chunk of a block, and which pairs belong to its bucket.

    Buckets are ordered by number: a pair belongs to the first one that its sets share.
    """
    node, first, second = (t.column(c)[0].as_py() for c in ("node", "low", "high"))
    chunks = np.array(t.column("own").to_pylist())
    ia, ib = np.flatnonzero(chunks == first), np.flatnonzero(chunks == second)
    shared = t.column("shared").combine_chunks()
    of = np.repeat(np.arange(len(chunks)), shared.value_lengths().to_numpy(zero_copy_only=False))
    nodes = shared.flatten().to_numpy(zero_copy_only=False)
    of, nodes = of[nodes < node], nodes[nodes < node]
    wanted = np.ones((len(ia), len(ib)), bool)
    place = np.full(len(chunks), -1)
    sides = []
    for rows in (ia, ib):
        place[:] = -1
        place[rows] = np.arange(len(rows))
        own = place[of] >= 0
        sides.append((place[of[own]], nodes[own], len(rows)))
    # Earlier buckets of both sides, some at a time.
    both = np.intersect1d(sides[0][1], sides[1][1])
    for start in range(0, len(both), MARKS):
        names = both[start : start + MARKS]
        marks = []
        for rows, own, n in sides:
            at = np.minimum(np.searchsorted(names, own), len(names) - 1)
            hit = names[at] == own
            m = np.zeros((n, len(names)), np.float32)
            m[rows[hit], at[hit]] = 1
            marks.append(m)
        wanted &= (marks[0] @ marks[1].T) == 0
    if first == second:
        wanted &= np.arange(len(ia))[:, None] < np.arange(len(ib))[None, :]
    return ia, ib, wanted


def _prune(p: Join):
    """Rows of a block that have an open partner by their sketches."""

    def open_rows(t: pa.Table) -> np.ndarray:
        ia, ib, wanted = _sides(t)
        open_ = np.zeros(t.num_rows, bool)
        if not wanted.any():
            return np.flatnonzero(open_)
        sketches = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, 128)
        right = sketches[ib]
        for i, row in zip(ia, wanted):
            at = np.flatnonzero(row)
            if len(at):
                other, own = right[at], sketches[i]
                used = ((other | own) != 0).sum(axis=1)
                hit = at[((other == own) & (own != 0)).sum(axis=1) >= p.sketch_least * used]
                if len(hit):
                    open_[i] = True
                    open_[ib[hit]] = True
        return np.flatnonzero(open_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for t in runs_of(batches, ["node", "low", "high"]):
            at = open_rows(t)
            if len(at):
                held.append(t.take(pa.array(at)).drop_columns(["sketch"]))
            if len(held) >= 500:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return run


def _compare(p: Join):
    """Links within a block: a table of the sets of one or two chunks of a bucket."""

    def block(t: pa.Table) -> list[tuple]:
        ia, ib, wanted = _sides(t)
        if not wanted.any():
            return []
        keys = t.column("key").to_pylist()
        copies = np.array(t.column("copies").to_pylist(), np.int64)
        sets = [np.frombuffer(m, np.uint32) for m in t.column("members").to_pylist()]
        hit = similar([sets[i] for i in ia], [sets[i] for i in ib], p.similarity, wanted)
        if not hit.any():
            return []
        texts, docs = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        np.add.at(texts, ia, hit.sum(axis=1))
        np.add.at(texts, ib, hit.sum(axis=0))
        np.add.at(docs, ia, hit @ copies[ib])
        np.add.at(docs, ib, copies[ia] @ hit)
        root = list(range(len(keys)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for x, y in zip(*np.nonzero(hit)):
            i, j = top(ia[x]), top(ib[y])
            if i != j:
                if keys[j] < keys[i]:
                    i, j = j, i
                root[j] = i
        return [(keys[i], int(texts[i]), int(docs[i]), keys[top(i)]) for i in np.flatnonzero(texts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for t in runs_of(batches, ["node", "low", "high"]):
            rows += block(t)
            if len(rows) > 5000:
                yield _link_batch(rows)
                rows = []
        if rows:
            yield _link_batch(rows)

    return run


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "text_links", "links", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(key, root): the smallest key of the component of every key in ``edges`` (a, b).

    Edges are turned by turns into edges from all neighbours, then from the smaller ones, to the smallest; the stars that
    remain are the components. Minima are aggregated before they are joined back, so a hot key has no list of neighbours.
    """
    edges = materialize(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # From every node, its larger neighbours to its minimum.
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large.filter(F.col("a") != F.col("b"))
        smaller = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(smaller, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter(F.col("a") != F.col("b")).distinct())
        found = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if tuple(found) == mark:
            return edges.select(F.col("a").alias("key"), F.col("b").alias("root"))
        mark = tuple(found)


def near_duplicates(df: DataFrame, p: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links, n_copies), one row per row of ``df``.

    ``class_id`` is the smallest id of the class; ``n_links`` counts the other rows of a similarity of ``similarity`` or
    more, ``n_text_links`` the different sets among them, ``n_copies`` the rows with the same set.
    """
    bounded_batches(df.sparkSession)
    texts = df.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(texts.mapInArrow(_summary(p), "id bigint, key binary, sketch binary, nodes array<bigint>"))
    reps = materialize(
        rows.groupBy("key").agg(
            F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes")
        )
    )
    placed = reps.select("key", F.explode("nodes").alias("node"))

    def counted(found: DataFrame, *by: str) -> DataFrame:
        return found.groupBy("node", *by).agg(F.count("*").alias("n")).filter("n > 1")

    def texts_of(found: DataFrame) -> DataFrame:
        """The texts that stand for the sets of ``found``."""
        ids = found.select("key").distinct().join(reps.select("key", F.col("rep").alias("id")), "key")
        return semi_join(texts, materialize(ids.select("id")), "id")

    found = materialize(placed.join(counted(placed), "node").select("key", "node", "n"))
    leaves = [found.filter(F.col("n") <= p.bucket)]
    large = found.filter(F.col("n") > p.bucket)
    for depth in range(2, p.depth + 1):
        if large.isEmpty():
            break
        parents = materialize(large.select(F.col("node").alias("parent"), F.col("n").alias("parent_n")).distinct())
        wanted = None
        if small_enough(parents, BROADCAST_ROWS):
            wanted = df.sparkSession.sparkContext.broadcast(parents.select("parent").toArrow()["parent"].to_numpy())
        children = texts_of(large).mapInArrow(_paths(p, depth, wanted), "key binary, parent bigint, node bigint")
        children = materialize(children.distinct().join(parents.select("parent"), "parent", "left_semi"))
        sizes = counted(children, "parent")
        most = sizes.groupBy("parent").agg(F.max("n").alias("most"))
        dense = materialize(most.join(parents, "parent").filter(F.col("most") > p.alike * F.col("parent_n")).select("parent"))
        leaves.append(large.join(dense.select(F.col("parent").alias("node")), "node", "left_semi").select("key", "node", "n"))
        parted = children.join(sizes, ["parent", "node"]).join(dense, "parent", "left_anti").select("key", "node", "n")
        parted = materialize(parted)
        leaves.append(parted.filter(F.col("n") <= p.bucket))
        large = parted.filter(F.col("n") > p.bucket)
    leaves.append(large)
    leaf = materialize(reduce(DataFrame.union, leaves))
    # Buckets with the same members: the first stands for all.
    h = F.xxhash64("key")
    same = leaf.groupBy("node").agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s"))
    kept = same.groupBy("n", "x", "s").agg(F.min("node").alias("node")).select("node")
    leaf = materialize(leaf.join(kept, "node", "left_semi"))
    shared = leaf.groupBy("key").agg(F.collect_set("node").alias("shared"))  # bounded by runs, fan-out and depth
    info = shared.join(reps.select("key", "copies", "sketch"), "key")
    chunks = F.ceil(F.col("n") / F.lit(p.chunk)).cast("int")
    own = F.pmod(F.xxhash64("key"), chunks).cast("int")
    blocks = (
        leaf.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select("key", "node", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .join(info, "key")
        .select("key", "node", "own", "low", "high", "copies", "shared", "sketch")
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_block(found: DataFrame) -> DataFrame:
        return found.repartition(parts, "node", "low", "high").sortWithinPartitions("node", "low", "high", "key")

    open_ = materialize(by_block(blocks).mapInArrow(_prune(p), BLOCK))
    sets = texts_of(open_).mapInArrow(_sets(p), "key binary, members binary").groupBy("key").agg(F.first("members").alias("members"))
    links = materialize(by_block(open_.join(sets, "key")).mapInArrow(_compare(p), LINKS))
    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("text_links").alias("text_links"), F.sum("links").alias("links"))
    classes = reps.select("key", "rep", "copies").join(roots, "key", "left").join(counts, "key", "left")
    classes = materialize(classes.withColumn("root", F.coalesce("root", "key")))
    names = classes.groupBy("root").agg(F.min(F.when(F.col("rep") != NO_ID, F.col("rep"))).alias("class_id"))
    out = classes.join(names, "root").select("key", "class_id", "copies", F.coalesce("text_links", F.lit(0)).alias("text_links"), F.coalesce("links", F.lit(0)).alias("links"))
    return rows.select("id", "key").join(out, "key").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "class_id",
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
        F.col("text_links").alias("n_text_links"),
        F.col("copies").alias("n_copies"),
    )
