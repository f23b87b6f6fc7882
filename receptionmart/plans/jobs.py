"""Loading and publishing jobs: check, write, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import manifest, quality
from ..sources import readers, writers
from . import analysis, dimension, matching, staging
from .views import TABLE_NAMES, Warehouse, artist_mart, register

TOP_ARTISTS = 10
STAGED = ("reviews", "tracks", "review_artists", "artist_universe", "artist_map")


@dataclass(frozen=True)
class LoadReport:
    reviews: int
    bridge_rows: int
    duplicate_pairs: int
    orphans: int
    top_artists: list[tuple[str, int]]


def _place(folder: str | None, table: str) -> str | None:
    return f"{folder}/{table}" if folder else None


def stage_files(reviews_raw: DataFrame, tracks_raw: DataFrame, sources: Sequence[DataFrame], folder: str) -> dict[str, str]:
    """Write typed reviews, clean tracks, bridge, artist universe and the ordered artist map as CSV; returns their paths.

    Bridge and universe are read again from what was written. Checks of reviews run before anything is written.
    """
    spark = reviews_raw.sparkSession
    paths = {name: f"{folder}/{name}" for name in STAGED}
    reviews, _ = staging.stage_reviews(reviews_raw)
    tracks = staging.clean_tracks(tracks_raw)
    writers.write_csv(staging.dates_as_text(reviews), paths["reviews"])
    writers.write_csv(tracks, paths["tracks"])
    writers.write_csv(staging.review_artists(reviews), paths["review_artists"])
    bridge = readers.read_csv(spark, paths["review_artists"], schemas.BRIDGE, multiline=True)
    quality.assert_clean(bridge, reviews)
    writers.write_csv(matching.artist_universe(bridge), paths["artist_universe"])
    universe = readers.read_csv(spark, paths["artist_universe"], schemas.UNIVERSE, multiline=True)
    named = matching.candidates(matching.candidate_names([tracks, *sources]))
    writers.write_csv(matching.map_order(matching.artist_map(universe, named)), paths["artist_map"])
    return paths


def export_core(warehouse: Warehouse, path: str) -> DataFrame:
    """Write the published columns of the core artists as CSV; returns the written frame."""
    core = analysis.core_artists(analysis.analysis_frame(artist_mart(warehouse)))
    writers.write_csv(analysis.export_frame(core), path)
    return readers.read_csv_inferred(core.sparkSession, path, multiline=True)


def check_drift(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Compare two written manifests; raises when a table lost more rows than the policy allows."""
    drift = manifest.compare(*[manifest.entries(readers.read_manifest(spark, path)) for path in (old, new)])
    manifest.require_no_loss(drift)
    return drift


def load_reviews_and_bridge(reviews: DataFrame, bridge: DataFrame, folder: str | None = None) -> LoadReport:
    """Write both tables, then report counts, repeated pairs, orphans and the most reviewed artists."""
    spark = reviews.sparkSession
    for frame, role in ((staging.dates_as_text(reviews), "reviews"), (bridge, "bridge")):
        writers.save_table(frame, TABLE_NAMES[role], _place(folder, TABLE_NAMES[role]))
    loaded, pairs = spark.table(TABLE_NAMES["reviews"]), spark.table(TABLE_NAMES["bridge"])
    counted = pairs.groupBy("artist").agg(F.count("*").alias("n"))
    return LoadReport(
        loaded.count(),
        pairs.count(),
        quality.repeated_keys(pairs, ["reviewid", "artist"]).count(),
        quality.orphans(pairs, loaded).count(),
        [(r.artist, r.n) for r in analysis.top(counted, TOP_ARTISTS, "n").collect()],
    )


def publish_dimension(mapped: DataFrame, folder: str | None = None) -> DataFrame:
    """Replace the dimension table; a failing check or write leaves the old one in place."""
    table = TABLE_NAMES["dimension"]
    writers.publish_version(dimension.artist_dimension(mapped), table, _place(folder, table))
    return mapped.sparkSession.table(table)


def publish_pairs(left: DataFrame, right: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Weighted matching of two artist columns into an accepted map and a review queue."""
    spark = left.sparkSession
    matches = f"{folder}/artist_matches"
    writers.write_parquet(matching.weighted_matches(matching.distinct_names(left), matching.distinct_names(right)), matches)
    written = spark.read.parquet(matches)
    accepted, queued = matching.accepted_pairs(written), matching.review_queue(written)
    writers.write_csv(accepted, f"{folder}/artist_map")
    writers.write_csv(queued, f"{folder}/artist_review_queue")
    return accepted, queued


def open_warehouse(spark: SparkSession) -> Warehouse:
    """The published tables, with all views registered; raises when one is missing."""
    warehouse = Warehouse(**{role: readers.require_table(spark, name) for role, name in TABLE_NAMES.items()})
    register(warehouse, tables=False)
    return warehouse


def inspect(spark: SparkSession, table: str, rows: int = 10) -> tuple[list[str], DataFrame, DataFrame]:
    """Table names, the columns of one table and a few of its rows."""
    frame = readers.require_table(spark, table)
    return readers.table_names(spark), readers.columns_of(frame, table), readers.sample(spark, table, rows)
