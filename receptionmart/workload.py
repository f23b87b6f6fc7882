"""The registered queries: every job, view and check of the package on the given star-schema tables.

Roles: an order is a review, a part is an artist, a line item credits a part in an order, and an event
is a track of the part its user id names. Parts below a size have no mapping. Free-text credits come from
whole document texts, listening-side name cells from whole pages and conversation turns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .operators import manifest as m
from .operators import quality, stats
from .operators.columns import numeric_columns
from .plans import analysis, dimension, matching, staging, views
from .session import configure, materialize
from .sources.readers import columns_of, spread, stored_bytes

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# Metrics of the given tables have two decimals, so their sums are taken exactly.
PLACES = 2
# Largest part size without a mapping, and smallest with an exact one.
UNMAPPED_SIZE, EXACT_SIZE = 5, 25
# Scores of the given tables average near 5, so "high" starts there.
HIGH_SCORE = 5.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _artist(key: str) -> Column:
    return F.concat(F.lit("Part#"), F.lpad(F.col(key).cast("string"), 9, "0"))


def _score() -> Column:
    return F.round(F.col("o_totalprice") / 5000) / 10


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("reviewid"),
        F.col("o_orderpriority").alias("title"),
        F.year("o_orderdate").alias("pub_year"),
        F.month("o_orderdate").alias("pub_month"),
        _score().alias("score"),
    )


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits with repeats, before they are made distinct."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("reviewid"), _artist("l_partkey").alias("artist"))


def mapped_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = F.col("p_size") > UNMAPPED_SIZE
    exact = F.col("p_size") >= EXACT_SIZE
    return table(spark, sf_dir, "part").select(
        _artist("p_partkey").alias("artist"),
        F.when(mapped, _artist("p_partkey")).alias("artist_spotify"),
        F.when(mapped & exact, "exact_norm").when(mapped, "jaccard_token").otherwise("").alias("match_type"),
        F.when(mapped & exact, 1.0).when(mapped, 0.75).otherwise(0.0).alias("score"),
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        _artist("user_id").alias("artist"),
        F.col("event_type").alias("song"),
        (k / 100).alias("danceability"),
        (k / 50).alias("energy"),
        (k / 20).alias("valence"),
        F.col("value").alias("streams"),
        k.alias("yt_views"),
        F.when(F.col("event_type") != "error", k).alias("yt_likes"),
        (k * 2).alias("yt_comments"),
    )


def distinct_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits without repeats.

    They seldom repeat, so they meet by review before they are made distinct: a scan task holds none of them, and a join by
    review needs no second shuffle.
    """
    return credits(spark, sf_dir).repartition("reviewid").distinct()


def warehouse(spark: SparkSession, sf_dir: str) -> views.Warehouse:
    return views.Warehouse(
        reviews(spark, sf_dir),
        distinct_credits(spark, sf_dir),
        mapped_artists(spark, sf_dir),
        tracks(spark, sf_dir),
    )


def text_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as credit lines."""
    return spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("reviewid"), F.col("text").alias("artist")))


def text_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.review_artists(text_credits(spark, sf_dir))


def text_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.artist_universe(text_bridge(spark, sf_dir))


def name_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Cells that hold JSON lists of names (whole pages) and cells of free text (whole turns)."""
    lists = spread(table(spark, sf_dir, "pages").select("html")).select(F.to_json(text.split_credits(F.col("html"))).alias("Artists"))
    return [lists, table(spark, sf_dir, "conversations").select(F.col("text").alias("artist_name"))]


def text_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.candidates(matching.candidate_names(name_cells(spark, sf_dir)))


# --- views and analysis -----------------------------------------------------------------------------------


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.artist_mart(warehouse(spark, sf_dir), PLACES)


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.analysis_frame(mart(spark, sf_dir))


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.core_artists(frame(spark, sf_dir))


def _rounded(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    """Logarithms and moments can differ in the last digit between engines."""
    return df.withColumns({c: F.round(c, places) for c in columns})


LOGS = ["log10_total_streams", "log10_avg_streams_per_track"]


def analysis_frame(spark, sf_dir):
    return _rounded(frame(spark, sf_dir), LOGS)


def core_export(spark, sf_dir):
    return _rounded(analysis.export_frame(core(spark, sf_dir)), LOGS[:1])


def correlation(spark, sf_dir):
    return _rounded(analysis.score_stream_correlation(frame(spark, sf_dir)), ["correlation"])


def correlation_core(spark, sf_dir):
    return _rounded(analysis.core_correlation(core(spark, sf_dir)), ["correlation"])


SLICE = ["artist", "avg_score", "review_count", "total_streams"]


def underrated(spark, sf_dir):
    return analysis.underrated(materialize(core(spark, sf_dir)), HIGH_SCORE).select(*SLICE)


def overrated(spark, sf_dir):
    return analysis.overrated(materialize(core(spark, sf_dir))).select(*SLICE)


def profile(spark, sf_dir):
    rows = materialize(mart(spark, sf_dir))
    return _rounded(stats.profile(rows, numeric_columns(rows)), ["mean", "std", "q1", "median", "q3"])


def quantiles(spark, sf_dir):
    """Quartiles of whole columns of the largest table."""
    metrics = ["l_quantity", "l_extendedprice"]
    return _rounded(stats.exact_quantiles(table(spark, sf_dir, "lineitem"), metrics, [0.25, 0.3, 0.7, 0.99]), ["quantile"])


def top_artists(spark, sf_dir):
    counted = warehouse(spark, sf_dir).bridge.groupBy("artist").agg(F.count("*").alias("n"))
    return analysis.top(counted, 10, "n")


def unmatched_top(spark, sf_dir):
    return analysis.top(views.unmatched_artists(warehouse(spark, sf_dir)), 20, "n_reviews")


def acclaimed(spark, sf_dir):
    return mart(spark, sf_dir).filter(F.col("avg_score") >= HIGH_SCORE)


def reviewed_twice(spark, sf_dir):
    return mart(spark, sf_dir).filter(F.col("review_count") >= 2).select("artist", "avg_score", "total_streams")


# --- staging ----------------------------------------------------------------------------------------------


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("reviewid"),
        F.col("o_orderpriority").alias("title"),
        _score().cast("string").alias("score"),
        F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("best_new_music"),
        dated.alias("pub_date"),
        F.year("o_orderdate").cast("string").alias("pub_year"),
        F.month("o_orderdate").cast("string").alias("pub_month"),
        F.dayofmonth("o_orderdate").cast("string").alias("pub_day"),
    )


def stage_reviews(spark, sf_dir):
    typed, _ = staging.stage_reviews(raw_reviews(spark, sf_dir))
    return staging.dates_as_text(typed)


def stage_checks(spark, sf_dir):
    return staging.review_report(staging.typed_reviews(raw_reviews(spark, sf_dir)))


def raw_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        _artist("user_id").alias(" Artist"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("Track"),
        (k / 100).alias("Danceability"),
        (k / 50).alias("Energy"),
        (k / 20).alias("Valence"),
        (k * 3).alias("Views"),
        k.alias("Stream"),
        F.col("props").alias("Url Youtube"),
    )


def clean_tracks(spark, sf_dir):
    return staging.clean_tracks(raw_tracks(spark, sf_dir))


def bridge_dedupe(spark, sf_dir):
    return text_bridge(spark, sf_dir)


def split_credits(spark, sf_dir):
    lines = text_credits(spark, sf_dir)
    parts = lines.select("reviewid", F.posexplode(text.split_credits(F.col("artist"))).alias("pos", "artist"))
    return parts.withColumn("pos", F.col("pos").cast("bigint"))


# --- matching and dimension -------------------------------------------------------------------------------


def json_candidates(spark, sf_dir):
    return text_candidates(spark, sf_dir)


def exact_match(spark, sf_dir):
    universe = matching.matchable(text_universe(spark, sf_dir))
    return matching.exact_match(universe, text_candidates(spark, sf_dir)).select(
        "artist", "artist_norm", "n_reviews", "artist_spotify", "match_type", "score"
    )


def text_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.artist_map(text_universe(spark, sf_dir), text_candidates(spark, sf_dir))


MAPPED = ["artist", "artist_norm", "n_reviews", "artist_spotify", "match_type", "score"]


def jaccard_match(spark, sf_dir):
    return text_map(spark, sf_dir).select(*MAPPED)


def text_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.artist_dimension(text_map(spark, sf_dir))


def dim_publish(spark, sf_dir):
    return text_dimension(spark, sf_dir).select("artist_key", *MAPPED)


def dim_ranking(spark, sf_dir):
    """Keep-first over keys that many rows share."""
    staged = table(spark, sf_dir, "part").select(
        _artist("p_partkey").alias("artist"),
        F.col("p_name").alias("artist_norm"),
        F.col("p_size").cast("bigint").alias("n_reviews"),
        F.col("p_brand").alias("artist_spotify"),
        F.col("p_type").alias("match_type"),
        F.col("p_retailprice").alias("score"),
    )
    return dimension.best_per_key(dimension.staged_map(staged)).select(*MAPPED)


def mapping_coverage(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return dimension.mapping_coverage(w.bridge, w.dimension)


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = matching.distinct_names(text_bridge(spark, sf_dir))
    right = spread(table(spark, sf_dir, "pages").select("html")).select(F.explode(text.split_credits(F.col("html"))).alias("artist"))
    return matching.weighted_matches(left, matching.distinct_names(right))


def weighted_match(spark, sf_dir):
    return matching.accepted_pairs(_weighted(spark, sf_dir))


def review_queue(spark, sf_dir):
    return matching.review_queue(_weighted(spark, sf_dir))


def name_forms(spark, sf_dir):
    """Every normal form of the distinct credited names."""
    name, key = F.col("name"), F.col("candidate_key")
    # The keys are columns before others are taken from them, so each is computed once.
    keys = {"universe_key": text.universe_key(name), "candidate_key": text.candidate_key(name)}
    return matching.distinct_names(text_bridge(spark, sf_dir)).withColumns(keys).select(
        "name",
        "universe_key",
        "candidate_key",
        text.cleaned_name(name).alias("cleaned"),
        text.is_company(name).alias("is_company"),
        text.prefix_bucket(key).alias("bucket"),
        F.size(text.tokens(key)).cast("bigint").alias("n_tokens"),
    )


def pair_verdicts(spark, sf_dir):
    """Acceptance rule on the pairs of part name and part type words."""
    pairs = table(spark, sf_dir, "part").select("p_name", F.lower("p_type").alias("p_type"), "p_size").distinct()
    score = F.col("p_size") + 50
    return pairs.select(
        "p_name", "p_type", "p_size", matching.acceptable_pair(F.col("p_name"), F.concat_ws(" ", F.substring_index("p_name", " ", 1), "p_type"), score).alias("accepted")
    )


# --- checks -----------------------------------------------------------------------------------------------


def row_counts(spark, sf_dir):
    return quality.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


def score_range(spark, sf_dir):
    return quality.score_range(reviews(spark, sf_dir))


def null_checks(spark, sf_dir):
    raw = raw_tracks(spark, sf_dir).select(F.col(" Artist").alias("artist"), F.col("Track").alias("song"))
    return quality.incomplete_tracks(raw)


def blank_artists(spark, sf_dir):
    return quality.blank_artists(table(spark, sf_dir, "documents").select(F.col("text").alias("artist")))


def orphans(spark, sf_dir):
    """Documents as bridge rows and labels as reviews: documents without a label."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("reviewid"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("reviewid"))
    return quality.orphans(docs, labels)


def duplicate_pairs(spark, sf_dir):
    return quality.repeated_keys(credits(spark, sf_dir), ["reviewid", "artist"])


def short_tokens(spark, sf_dir):
    """Short words of conversation turns that are on no list."""
    words = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("reviewid"), F.explode(text.words(F.lower("text"))).alias("artist")
    )
    return quality.short_tokens(words).groupBy("artist").agg(F.count("*").alias("n"))


def key_checks(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("artist_norm"))
    return quality.repeated_keys(parts, ["artist_norm"])


# --- manifests --------------------------------------------------------------------------------------------

def manifest(spark, sf_dir):
    return m.table_manifest({t: table(spark, sf_dir, t) for t in TABLES}, "md5")


def _entries(tables: dict[str, DataFrame]) -> DataFrame:
    return m.table_manifest(tables, "md5").select("table_name", F.col("n_rows").alias("rows"), F.col("fingerprint").alias("hash"))


def manifest_drift(spark, sf_dir):
    get = partial(table, spark, sf_dir)
    old = {"orders": get("orders"), "part": get("part"), "events": get("events"), "customer": get("customer")}
    new = {
        "orders": get("orders").filter("o_orderstatus <> 'P'"),
        "part": get("part"),
        "events": get("events").withColumn("event_type", F.upper("event_type")),
        "supplier": get("supplier"),
    }
    return _rounded(m.compare(_entries(old), _entries(new)), ["delta_pct"])


def manifest_totals(spark, sf_dir):
    each = [m.sizes(table(spark, sf_dir, t), t) for t in TABLES]
    return m.totals(reduce(DataFrame.unionByName, each))


def file_hashes(spark, sf_dir):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(sf_dir)
    return m.file_hashes(files).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "bytes", "sha256")


def source_profile(spark, sf_dir):
    frames = [columns_of(table(spark, sf_dir, t), t) for t in TABLES]
    counts = row_counts(spark, sf_dir).withColumnRenamed("tbl", "table_name")
    together = frames[0]
    for f in frames[1:]:
        together = together.unionByName(f)
    return together.join(counts, "table_name").withColumnRenamed("n", "n_rows")


def _view(view: Callable[..., DataFrame], *args) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: view(warehouse(spark, sf_dir), *args)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "review_with_artist": _view(views.review_with_artist),
    "unmatched_artists": _view(views.unmatched_artists),
    "coverage_by_year": _view(views.coverage_by_year),
    "artist_summary": _view(views.artist_summary, PLACES),
    "artist_streams": _view(views.artist_streams, PLACES),
    "artist_mart": mart,
    "analysis_frame": analysis_frame,
    "core_artists": core_export,
    "correlation": correlation,
    "correlation_core": correlation_core,
    "underrated": underrated,
    "overrated": overrated,
    "profile": profile,
    "quantiles": quantiles,
    "top_artists": top_artists,
    "unmatched_top": unmatched_top,
    "acclaimed_artists": acclaimed,
    "reviewed_twice": reviewed_twice,
    "stage_reviews": stage_reviews,
    "stage_checks": stage_checks,
    "clean_tracks": clean_tracks,
    "split_credits": split_credits,
    "bridge_dedupe": bridge_dedupe,
    "artist_universe": text_universe,
    "name_forms": name_forms,
    "json_candidates": json_candidates,
    "exact_match": exact_match,
    "jaccard_match": jaccard_match,
    "weighted_match": weighted_match,
    "review_queue": review_queue,
    "pair_verdicts": pair_verdicts,
    "dim_publish": dim_publish,
    "dim_ranking": dim_ranking,
    "mapping_coverage": mapping_coverage,
    "row_counts": row_counts,
    "score_range": score_range,
    "null_checks": null_checks,
    "blank_artists": blank_artists,
    "orphans": orphans,
    "duplicate_pairs": duplicate_pairs,
    "short_tokens": short_tokens,
    "key_checks": key_checks,
    "manifest": manifest,
    "manifest_drift": manifest_drift,
    "manifest_totals": manifest_totals,
    "file_hashes": file_hashes,
    "source_profile": source_profile,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries on a session with the settings they rely on."""

    def on_session(query):
        return lambda spark, sf_dir: query(configure(spark, stored_bytes(spark, sf_dir)), sf_dir)

    return {name: on_session(query) for name, query in QUERIES.items()}
