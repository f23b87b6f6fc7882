"""Hard negatives by threshold joins over an inverted index of integer vectors.

An anchor's positives are the rows of its label with the largest inner products. For each positive, a window of scores
follows from its own score, and the best rows of other labels in that window are the hard negatives.

Rows and anchors are dealt into blocks and every block of rows meets every block of anchors. A block of rows is indexed by
groups of dimensions, those with the most energy first. The posting list of a group holds a row only while the norm of the
row's suffix from there on, times the longest anchor, can reach the lowest threshold of the block; the omitted suffix is
kept beside the index. An anchor walks the lists, adds partial products, and drops a row as soon as its partial score plus
the product of both remaining norms is under the threshold; the bound at which it fell is kept. If the windows aren't full
yet the threshold is lowered, and the rows whose bounds reach it are taken up again. Found scores are whole products, so the
result is exact. Blocks hand on as many rows as are asked for at most, and a ranking by score and id merges them.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; other vectors are
padded with zeros to the longest; an empty vector scores 0 with all. Each row is a row of its own, whatever its id: rows of
one id rank by their place. A null id ranks last. Equal scores rank by id. A positive with a score under 0 has an empty
window, one of 0 takes scores of exactly 0. An anchor without another row of its label, or without negatives in its windows,
gives no row; empty tables give an empty result. Scaled components of 2**26 or more fail, as scores might pass 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FOUND = "anchor bigint, slot int, other bigint, other_id bigint, score bigint"
FOUND_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
#: Smaller components keep products of up to 2,000 dimensions within 64 bits.
LARGEST = 1 << 26


@dataclass(frozen=True)
class Rule:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50
    high_percent: int = 95
    #: Rows and anchors that meet in one group, and dimensions of one posting list.
    row_block: int = 4096
    anchor_block: int = 4096
    dimensions: int = 16
    #: Steps in which a threshold goes down to the lowest one.
    steps: int = 4


class Index:
    """Posting lists of a block of vectors for thresholds from ``floor`` on and anchors of norm ``longest`` at most."""

    def __init__(self, x: np.ndarray, floor: float, longest: float, width: int):
        self.order = np.argsort(-np.square(x, dtype=np.float64).sum(0), kind="stable")
        self.x, self.width = x[:, self.order], width
        square = np.square(self.x, dtype=np.float64)
        self.starts = list(range(0, x.shape[1], width))
        sums = [square[:, s : s + width].sum(1) for s in self.starts]
        #: Norms of what is left from each group on.
        self.rest = np.sqrt(np.cumsum([*sums, np.zeros(len(x))][::-1], axis=0)[::-1])
        self.slack = 1.0 + 1e-9 * self.rest[0] * longest
        self.lists = []
        held = np.arange(len(x))
        #: In how many lists a row is; they are the first ones.
        self.depth = np.zeros(len(x), np.int64)
        for g, s in enumerate(self.starts):
            held = held[self.rest[g, held] * longest + self.slack[held] >= floor]
            self.depth[held] += 1
            place = np.full(len(x), -1)
            place[held] = np.arange(len(held))
            self.lists.append((place, self.x[held, s : s + width]))

    def bounds(self, q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows that may reach ``threshold``, their products over the lists, upper bounds of all rows).

        The products leave out the suffixes that aren't in the lists; ``finish`` adds them.
        """
        left = np.sqrt(np.cumsum([*(np.square(q[s : s + self.width], dtype=np.float64).sum() for s in self.starts), 0.0][::-1])[::-1])
        upper = self.rest[0] * left[0] + self.slack
        live = np.flatnonzero(upper >= threshold)
        part = np.zeros(len(self.x), self.x.dtype)
        done = []
        for g, (place, values) in enumerate(self.lists):
            at = place[live]
            listed = at >= 0
            if not listed.all():
                done.append(live[~listed])
                live, at = live[listed], at[listed]
            found = values[at] @ q[self.starts[g] : self.starts[g] + self.width]
            found += part[live]
            bound = self.rest[g + 1, live]
            bound *= left[g + 1]
            bound += found
            bound += self.slack[live]
            part[live], upper[live] = found, bound
            live = live[bound >= threshold]
        return np.concatenate([*done, live]), part, upper

    def finish(self, q: np.ndarray, rows: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Whole products of ``rows``: what the lists hold of them is in ``part``."""
        out, depth = part[rows], self.depth[rows]
        for g in range(int(depth.min(initial=len(self.lists))), len(self.lists)):
            omitted, s = np.flatnonzero(depth <= g), self.starts[g]
            out[omitted] += self.x[rows[omitted], s : s + self.width] @ q[s : s + self.width]
        return out

    def search(self, q: np.ndarray, thresholds: list[float], enough) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of at least all scores from some threshold on at which ``enough(rows, scores, threshold)`` holds."""
        q = q[self.order]
        rows, part, upper = self.bounds(q, thresholds[0])
        known = np.zeros(len(self.x), bool)
        known[rows] = True
        scores = self.finish(q, rows, part)
        for k, threshold in enumerate(thresholds):
            if k:
                again = np.flatnonzero(~known & (upper >= threshold))
                known[again] = True
                rows = np.concatenate([rows, again])
                scores = np.concatenate([scores, self.x[again] @ q])
            if enough(rows, scores, threshold):
                break
        return rows, scores


def _steps(high: float, low: float, steps: int) -> list[float]:
    return [low + (high - low) * (steps - k) / steps for k in range(steps)] + [low] if high > low else [low]


def _vectors(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _exact_kind(x: np.ndarray, q: np.ndarray):
    """A number type in which all products of the two are exact."""
    most = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _sides(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    width = max(1, *(max(t.column("vector").combine_chunks().value_lengths().to_pylist()) for t in (rows, anchors)))
    x, q = _vectors(rows.column("vector"), width), _vectors(anchors.column("vector"), width)
    kind = _exact_kind(x, q)
    return x.astype(kind), q.astype(kind)


def _ids(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Row numbers, ids for ordering (with whether they are null), and ids as they are."""
    ids = rows.column("vec_id").combine_chunks()
    return (
        rows.column("row").to_numpy(),
        ids.is_null().to_numpy(zero_copy_only=False),
        ids.fill_null(0).to_numpy(zero_copy_only=False),
        ids.to_pylist(),
    )


def _table(found: list[tuple]) -> pa.Table:
    columns = list(zip(*found)) or [()] * len(FOUND_KINDS)
    return pa.table([pa.array(c, k) for c, k in zip(columns, FOUND_KINDS)], [p.split()[0] for p in FOUND.split(", ")])


def _find_positives(rule: Rule):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if not rows.num_rows or not anchors.num_rows:
            return _table(found)
        x, q = _sides(rows, anchors)
        number, no_id, order_id, ids = _ids(rows)
        labels, wanted = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
        anchor_rows = anchors.column("row").to_numpy()
        longest = float(np.sqrt(np.square(q, dtype=np.float64).sum(1).max()))
        for label in np.unique(wanted):
            members = np.flatnonzero(labels == label)
            if not len(members):
                continue
            index = Index(x[members], -np.inf, longest, rule.dimensions)
            for a in np.flatnonzero(wanted == label):
                most = float(index.rest[0].max()) * float(np.sqrt(np.square(q[a], dtype=np.float64).sum()))
                # The anchor itself may be among the rows.
                at, scores = index.search(
                    q[a],
                    [*_steps(0.9 * most, 0.0, rule.steps), -np.inf],
                    lambda rows_, s, t: np.count_nonzero(s >= t) > rule.positives,
                )
                at = members[at]
                other = number[at] != anchor_rows[a]
                at, scores = at[other], scores[other]
                best = np.lexsort((number[at], order_id[at], no_id[at], -scores))[: rule.positives]
                found += [(int(anchor_rows[a]), 0, int(number[at[k]]), ids[at[k]], int(scores[k])) for k in best]
        return _table(found)

    return run


def _find_negatives(rule: Rule):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if not rows.num_rows or not anchors.num_rows:
            return _table(found)
        x, q = _sides(rows, anchors)
        number, no_id, order_id, ids = _ids(rows)
        labels, wanted = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
        anchor_rows = anchors.column("row").to_numpy()
        windows = [
            [(slot, -(-rule.low_percent * p // 100), rule.high_percent * p // 100) for slot, p in zip(s, scores)]
            for s, scores in zip(anchors.column("slots").to_pylist(), anchors.column("scores").to_pylist())
        ]
        windows = [[w for w in listed if w[1] <= w[2]] for listed in windows]
        lowest = [w[1] for listed in windows for w in listed]
        if not lowest:
            return _table(found)
        longest = float(np.sqrt(np.square(q, dtype=np.float64).sum(1).max()))
        index = Index(x, min(lowest), longest, rule.dimensions)
        for a, listed in enumerate(windows):
            if not listed:
                continue
            other = labels != wanted[a]

            def enough(at, scores, threshold, listed=listed, other=other):
                own = scores[other[at] & (scores >= threshold)]
                return all(low >= threshold or np.count_nonzero((own >= low) & (own <= high)) >= rule.negatives for _, low, high in listed)

            at, scores = index.search(q[a], _steps(max(w[2] for w in listed), min(w[1] for w in listed), rule.steps), enough)
            keep = other[at]
            at, scores = at[keep], scores[keep]
            best = np.lexsort((number[at], order_id[at], no_id[at], -scores))
            at, scores = at[best], scores[best]
            for slot, low, high in listed:
                for k in np.flatnonzero((scores >= low) & (scores <= high))[: rule.negatives]:
                    found.append((int(anchor_rows[a]), slot, int(number[at[k]]), ids[at[k]], int(scores[k])))
        return _table(found)

    return run


def _met(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, find) -> DataFrame:
    """Every block of rows with every block of anchors."""
    left = rows.withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    # New columns, since both sides come from the same rows.
    right = anchors.select(*[F.col(c).alias(c) for c in anchors.columns]).withColumn("anchor_block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(anchor_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))
    )
    keys = ["block", "anchor_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, FOUND)


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def mine_negatives(
    df: DataFrame, is_anchor: Column, rule: Rule = Rule(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    ``is_anchor`` is a condition on the columns of ``df``; null is no.
    """
    finite = F.forall(F.col(vector_col), lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    usable = df.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite)
    scaled = F.transform(F.col(vector_col), lambda v: F.floor(v.cast("double") * rule.scale))
    checked = F.when(
        F.exists("vector", lambda v: F.abs(v) >= LARGEST), F.raise_error(F.lit("a scaled component is 2**26 or more"))
    ).otherwise(F.transform("vector", lambda v: v.cast("int")))
    rows = usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(is_anchor.cast("boolean"), F.lit(False)).alias("is_anchor"),
        scaled.alias("vector"),
    ).withColumn("vector", checked)
    rows = materialize(rows)
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    row_blocks, anchor_blocks = max(1, -(-n_rows // rule.row_block)), max(1, -(-n_anchors // rule.anchor_block))
    anchors = rows.filter("is_anchor").select("row", "label", "vector")
    rows = rows.select("row", "vec_id", "label", "vector", F.pmod(F.xxhash64("row"), F.lit(row_blocks)).cast("int").alias("block"))

    positives = materialize(_ranked(_met(rows, anchors, row_blocks, anchor_blocks, _find_positives(rule)), rule.positives))
    windows = positives.groupBy(F.col("anchor").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found")  # at most ``positives``
    )
    windows = windows.select("row", F.col("found.rank").alias("slots"), F.col("found.score").alias("scores"))
    found = _ranked(_met(rows, anchors.join(windows, "row"), row_blocks, anchor_blocks, _find_negatives(rule)), rule.negatives)
    ids = rows.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    named = positives.select("anchor", F.col("rank").alias("slot"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.join(named, ["anchor", "slot"])
        .join(ids, "anchor")
        .select(
            "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"), F.col("slot").alias("positive_rank"),
        )
    )
