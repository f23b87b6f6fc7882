"""Correlation, exact quantiles and column profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Buckets a range of values is cut into in one round.
BUCKETS = 64
# Distinct values of a range that are put in order in one task; must be at least BUCKETS.
LISTED = 1_000_000


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, over the rows where both are present."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(F.inline(cells))


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(cells)).filter(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles as rows (metric, probability, n, quantile).

    Equal values are merged once for all quantiles. Each wanted rank then has a range of values that holds it; a round cuts
    every range that is still too wide into buckets, counts their rows exactly and keeps the bucket with the rank. A range of
    at most LISTED distinct values is put in order. The cuts decide how many rounds there are, never the result.
    """
    return _quantiles_of_long(_long(df, columns), probabilities)


@dataclass(frozen=True)
class _Range:
    """Values ``low`` to ``high`` of a metric, the rows below them and the distinct values among them."""

    metric: str
    low: float
    high: float
    below: int
    distinct: int


def _within(counts: DataFrame, ranges: Sequence[_Range]) -> DataFrame:
    """Counted values in one of the ranges, with its position in the list; there are at most two ranges per quantile."""
    rows = [(i, r.metric, r.low, r.high, r.below) for i, r in enumerate(ranges)]
    listed = counts.sparkSession.createDataFrame(rows, "range INT, owner STRING, low DOUBLE, high DOUBLE, below BIGINT")
    inside = (F.col("metric") == F.col("owner")) & F.col("value").between(F.col("low"), F.col("high"))
    return counts.join(F.broadcast(listed), inside).select("range", "below", "value", "rows")


def _buckets(counts: DataFrame, ranges: Sequence[_Range]) -> list[list[_Range]]:
    """Each range cut at values that part its distinct values about evenly."""
    inside = _within(counts, ranges)
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = inside.groupBy("range").agg(F.percentile_approx("value", shares, 4 * BUCKETS).alias("cuts"))
    cut = (
        inside.join(F.broadcast(cuts), "range")
        .groupBy("range", F.size(F.filter("cuts", lambda c: c < F.col("value"))).alias("bucket"))
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("distinct"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    parted: list[list[_Range]] = [[] for _ in ranges]
    below = [r.below for r in ranges]
    for b in sorted(cut.collect(), key=lambda b: (b["range"], b["bucket"])):
        parted[b["range"]].append(_Range(ranges[b["range"]].metric, b["low"], b["high"], below[b["range"]], b["distinct"]))
        below[b["range"]] += b["rows"]
    return parted


def _narrowed(counts: DataFrame, places: dict[tuple[str, int], _Range]) -> tuple[dict[tuple[str, int], _Range], int]:
    """For each (metric, rank) a range of few distinct values, and the number of rounds it took."""
    rounds = 0
    while wide := list(dict.fromkeys(r for r in places.values() if r.distinct > LISTED)):
        parts = dict(zip(wide, _buckets(counts, wide)))
        places = {
            (metric, rank): [p for p in parts[r] if p.below <= rank][-1] if r in parts else r
            for (metric, rank), r in places.items()
        }
        rounds += 1
    return places, rounds


def _quantiles_of_long(long: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    spark = long.sparkSession
    counts = materialize(long.groupBy("metric", "value").agg(F.count("*").alias("rows")))
    wholes = counts.groupBy("metric").agg(
        F.sum("rows").alias("n"), F.count("*").alias("distinct"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    places, targets = {}, []
    for m in wholes.collect():
        for p in map(float, probabilities):
            position = (m.n - 1) * p
            for rank in {math.floor(position), math.ceil(position)}:
                places[m.metric, rank] = _Range(m.metric, m.low, m.high, 0, m.distinct)
                targets.append((m.metric, p, m.n, position - math.floor(position), rank))
    places, _ = _narrowed(counts, places)
    ranges = list(dict.fromkeys(places.values()))
    at = {r: i for i, r in enumerate(ranges)}
    wanted = spark.createDataFrame(
        [(*t, at[places[t[0], t[-1]]]) for t in targets],
        "metric STRING, probability DOUBLE, n BIGINT, part DOUBLE, rank BIGINT, range INT",
    )
    last = F.col("below") + F.sum("rows").over(Window.partitionBy("range").orderBy("value"))
    ordered = _within(counts, ranges).select("range", "value", (last - F.col("rows")).alias("first"), last.alias("next"))
    holds = (F.col("o.range") == F.col("w.range")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("next"))
    found = (
        ordered.alias("o")
        .join(F.broadcast(wanted.alias("w")), holds)
        .groupBy("metric", "probability", "n", "part")
        .agg(F.min("value").alias("lower"), F.max("value").alias("upper"))
    )
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("part")
    return found.select("metric", "probability", "n", between.alias("quantile"))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each column, one row per column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    long = _long(df, columns)
    moments = long.groupBy("metric").agg(
        F.count("value").alias("non_null"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = (
        _quantiles_of_long(long, (0.25, 0.5, 0.75))
        .groupBy("metric")
        .agg(
            *[
                F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(n)
                for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
            ]
        )
    )
    dtype = reduce(lambda acc, c: acc.when(F.col("metric") == c, types[c]), columns, F)
    return moments.join(quartiles, "metric", "left").select(
        F.col("metric").alias("column_name"), dtype.alias("dtype"), "non_null", "mean", "std", "min", "q1", "median", "q3", "max"
    )
