import math

import pytest
from pyspark.sql import functions as F

from receptionmart.functions.numbers import Metric, share
from receptionmart.operators.stats import exact_quantiles
from receptionmart.operators import stats
from receptionmart.plans import analysis, views


@pytest.fixture(scope="module")
def w(spark):
    reviews = spark.createDataFrame(
        [(1, "One", 2001, 5, 10.0), (2, "Two", 2001, 6, 4.0), (3, "Three", None, 1, 8.0), (4, "Four", 2003, 2, 6.0)],
        "reviewid BIGINT, title STRING, pub_year INT, pub_month INT, score DOUBLE",
    )
    bridge = spark.createDataFrame(
        [(1, "A"), (1, "a"), (2, "A"), (3, "B"), (3, "nobody"), (4, "listed"), (9, "A")], "reviewid BIGINT, artist STRING"
    )
    dimension = spark.createDataFrame(
        [("A", "S", "exact_norm", 1.0), ("a", "S", "jaccard_token", 0.7), ("B", "foo", "exact_norm", 1.0), ("listed", None, "", 0.0)],
        "artist STRING, artist_spotify STRING, match_type STRING, score DOUBLE",
    )
    tracks = spark.createDataFrame(
        [("S", 10.0, 1.0), ("S", None, 2.0), ("Foo", 5.0, 1.0)], "artist STRING, streams DOUBLE, yt_views DOUBLE"
    )
    for c in ("yt_likes", "yt_comments", "danceability", "energy", "valence"):
        tracks = tracks.withColumn(c, F.lit(0.5))
    return views.Warehouse(reviews, bridge, dimension, tracks)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_review_rows(w):
    got = rows(views.review_with_artist(w), "reviewid", "bridge_artist", "artist_spotify", "match_conf")
    assert len(got) == 6
    assert (1, "a", "S", 0.7) in got and (3, "nobody", None, None) in got and (4, "listed", None, 0.0) in got


def test_unmatched_holds_missing_and_null_mappings(w):
    assert rows(views.unmatched_artists(w), "artist", "n_reviews") == [("listed", 1), ("nobody", 1)]


def test_coverage_ignores_null_year_for_mapped(w):
    got = {r.pub_year: (r.artists_total, r.artists_mapped, r.pct_mapped) for r in views.coverage_by_year(w).collect()}
    assert got == {2001: (2, 2, 1.0), None: (2, 0, 0.0), 2003: (1, 0, 0.0)}


@pytest.mark.parametrize("places", [None, 2])
def test_summary_counts_reviews_once_and_scores_per_credit(w, places):
    got = {r.artist: r for r in views.artist_summary(w, places).collect()}
    assert (got["S"].review_count, got["S"].avg_score, got["S"].min_score, got["S"].max_score) == (2, 8.0, 4.0, 10.0)
    assert (got["S"].first_review_year, got["foo"].first_review_year) == (2001, None)


def test_streams_count_null_rows_but_not_null_values(w):
    got = {r.artist: r for r in views.artist_streams(w).collect()}
    assert (got["S"].track_count, got["S"].total_streams, got["S"].avg_streams_per_track) == (2, 10.0, 10.0)


def test_mart_keeps_artists_without_tracks(w):
    got = {r.artist: (r.review_count, r.track_count, r.total_streams) for r in views.artist_mart(w).collect()}
    assert got == {"S": (2, 2, 10.0), "foo": (1, None, None)}


def test_registered_views_answer_sql(spark, w):
    names = views.register(w)
    views.register(w)
    assert len(names) == 10
    got = spark.sql("SELECT artist, avg_score FROM vw_artist_critics_vs_streams WHERE review_count >= 2 ORDER BY total_streams DESC")
    assert [tuple(r) for r in got.collect()] == [("S", 8.0)]
    assert spark.sql("SELECT * FROM vw_unmatched_artists ORDER BY n_reviews DESC, artist LIMIT 20").count() == 2


def test_exact_metric_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "x DOUBLE")
    total, mean, empty = df.select(
        Metric(2).total(F.col("x")), Metric(2).mean(F.col("x")), Metric(2).mean(F.when(F.col("x") > 9, F.col("x")))
    ).first()
    assert (total, mean, empty) == (0.6, 0.2, None)


def test_share_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 16), (201, 400), (1, 0)], "a BIGINT, b BIGINT")
    assert [r[0] for r in df.select(share(F.col("a"), F.col("b"))).collect()] == [0.063, 0.503, None]


# --- analysis ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def mart(spark):
    data = [(f"a{i:02d}", 2 if i else 1, i / 2, float(10**i) if i < 12 else None, 6) for i in range(20)]
    df = spark.createDataFrame(data, "artist STRING, review_count BIGINT, avg_score DOUBLE, total_streams DOUBLE, track_count BIGINT")
    return df.withColumn("avg_streams_per_track", F.when(F.col("artist") == "a03", 0.0).otherwise(F.col("total_streams")))


def test_frame_and_core(mart):
    frame = analysis.analysis_frame(mart)
    got = {r.artist: r for r in frame.collect()}
    assert len(got) == 12
    assert got["a05"].log10_total_streams == 5.0 and got["a03"].log10_avg_streams_per_track is None
    assert analysis.core_artists(frame).count() == 11


def test_correlation(mart):
    got = {(r.left, r.right): r.correlation for r in analysis.core_correlation(analysis.analysis_frame(mart)).collect()}
    assert got[("avg_score", "log10_total_streams")] == pytest.approx(1.0)
    assert len(got) == 3


def test_slices(mart):
    core = analysis.core_artists(analysis.analysis_frame(mart))
    # Streams run over 10^1 to 10^11, so the quantiles are 4 and 8.
    assert [r.artist for r in analysis.by_score(analysis.underrated(core, high_score=1.0)).collect()] == ["a04", "a03", "a02"]
    assert [r.artist for r in analysis.by_streams(analysis.overrated(core, low_score=5.0)).collect()] == ["a10", "a09", "a08"]


@pytest.mark.parametrize("listed", [1_000_000, 64, 8])
def test_quantiles_equal_sorted_interpolation(spark, monkeypatch, listed):
    # Narrow lists make the rounds real even on little data.
    monkeypatch.setattr(stats, "BUCKETS", 8)
    monkeypatch.setattr(stats, "LISTED", listed)
    values = [float((i * i) % 997) for i in range(600)] + [500.0] * 300 + [1e300, -1e300, None, None]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").withColumn("y", -F.col("x"))
    ordered = sorted(v for v in values if v is not None)
    probabilities = [0.0, 0.3, 0.5, 0.99, 1.0]
    got = {(r.metric, r.probability): r.quantile for r in exact_quantiles(df, ["x", "y"], probabilities).collect()}
    assert len(got) == 10
    for p in probabilities:
        h = (len(ordered) - 1) * p
        low, high = ordered[math.floor(h)], ordered[math.ceil(h)]
        assert got[("x", p)] == pytest.approx(low + (high - low) * (h - math.floor(h)))
    assert got[("y", 0.5)] == -got[("x", 0.5)]


def test_quantiles_take_as_many_rounds_as_needed(spark, monkeypatch):
    monkeypatch.setattr(stats, "BUCKETS", 8)
    monkeypatch.setattr(stats, "LISTED", 10)
    counts = spark.range(3000).select(F.lit("x").alias("metric"), F.col("id").cast("double").alias("value"), F.lit(2).cast("bigint").alias("rows"))
    whole = stats._Range("x", 0.0, 2999.0, 0, 3000)
    places, rounds = stats._narrowed(counts, {("x", 0): whole, ("x", 3001): whole, ("x", 5999): whole})
    assert rounds > 1
    for (_, rank), place in places.items():
        assert place.distinct <= 10 and place.low <= rank // 2 <= place.high and place.below == 2 * place.low


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "x DOUBLE, y DOUBLE")
    assert [(r.metric, r.n, r.quantile) for r in exact_quantiles(df, ["x", "y"], [0.5]).collect()] == [("y", 2, 2.0)]
    assert exact_quantiles(df.limit(0), ["x", "y"], [0.5]).collect() == []


def test_sums_refuse_further_places(spark):
    df = spark.createDataFrame([(0.1234,), (0.0049,)], "x DOUBLE")
    assert df.agg(Metric(4).mean(F.col("x"))).first()[0] == 0.06415
    with pytest.raises(Exception, match="more decimal places"):
        df.agg(Metric(2).mean(F.col("x"))).collect()


def test_profile(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0), (4, 9.0)], "i INT, d DOUBLE")
    got = {r.column_name: r for r in stats.profile(df, ["i", "d"]).collect()}
    assert (got["i"].dtype, got["i"].non_null, got["i"].mean, got["i"].q1, got["i"].median) == ("int", 4, 2.5, 1.75, 2.5)
    assert (got["d"].non_null, got["d"].median, got["d"].max) == (3, 4.0, 9.0)


def test_top_ends_in_a_unique_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("d", None)], "artist STRING, n INT")
    assert [r.artist for r in analysis.top(df, 3, "n").collect()] == ["c", "a", "b"]
