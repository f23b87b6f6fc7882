"""Semantic views over reviews, bridge, dimension and tracks."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import Metric, share

# Names under which base tables and views are registered for SQL users.
TABLE_NAMES = {
    "reviews": "pitchfork_reviews",
    "bridge": "pitchfork_review_artists",
    "dimension": "dim_artist",
    "tracks": "spotify_youtube_clean",
}


@dataclass(frozen=True)
class Warehouse:
    """Base tables of the mart."""

    reviews: DataFrame
    bridge: DataFrame
    dimension: DataFrame
    tracks: DataFrame


def review_with_artist(w: Warehouse) -> DataFrame:
    """One row per review and credited artist with the artist's mapping, if any."""
    mapping = w.dimension.select(
        F.col("artist").alias("bridge_artist"), "artist_spotify", "match_type", F.col("score").alias("match_conf")
    )
    facts = w.reviews.select("reviewid", "title", "pub_year", "pub_month", "score")
    credits = w.bridge.select("reviewid", F.col("artist").alias("bridge_artist"))
    return (
        credits.join(facts, "reviewid")
        .join(mapping, "bridge_artist", "left")
        .select(*facts.columns, "bridge_artist", "artist_spotify", "match_type", "match_conf")
    )


def unmatched_artists(w: Warehouse) -> DataFrame:
    """Credited artists without a mapping and how many reviews each has. Sort when reading.

    Credits are counted per artist before the dimension is joined, so an artist with very many credits
    is one row there. An artist listed several times without a mapping counts that many times.
    """
    counted = (
        w.bridge.join(w.reviews.select("reviewid"), "reviewid").groupBy("artist").agg(F.count("*").alias("n_credits"))
    )
    listed = w.dimension.groupBy("artist").agg(F.count_if(F.col("artist_spotify").isNull()).alias("n_unmapped"))
    return (
        counted.join(listed, "artist", "left")
        .select("artist", (F.col("n_credits") * F.coalesce("n_unmapped", F.lit(1))).alias("n_reviews"))
        .filter(F.col("n_reviews") > 0)
    )


def coverage_by_year(w: Warehouse) -> DataFrame:
    """Distinct artists per publication year and how many of them are mapped. Sort when reading.

    The pairs are made distinct before the dimension is joined, so the join sees one row per year and
    artist, and each count is a plain count. A NULL year has artists but no mapped ones.
    """
    pairs = w.bridge.join(w.reviews.select("reviewid", "pub_year"), "reviewid").select("pub_year", "artist").distinct()
    mapped = w.dimension.filter(F.col("artist_spotify").isNotNull()).select("artist", F.lit(True).alias("is_mapped")).distinct()
    counted = (
        pairs.join(mapped, "artist", "left")
        .groupBy("pub_year")
        .agg(
            F.count("artist").alias("artists_total"),
            F.count(F.when(F.col("pub_year").isNotNull(), F.col("is_mapped"))).alias("artists_mapped"),
        )
    )
    return counted.withColumn("pct_mapped", share(F.col("artists_mapped"), F.col("artists_total")))


def artist_summary(w: Warehouse, places: int | None = None) -> DataFrame:
    """Critic summary per mapped artist.

    Reviews are counted once, but a score counts once per credit: two credited names that map to the
    same artist put it into the mean twice.
    """
    metric = Metric(places)
    return (
        review_with_artist(w)
        .filter(F.col("artist_spotify").isNotNull())
        .groupBy(F.col("artist_spotify").alias("artist"))
        .agg(
            F.count_distinct("reviewid").alias("review_count"),
            metric.mean(F.col("score")).alias("avg_score"),
            F.min("score").alias("min_score"),
            F.max("score").alias("max_score"),
            F.min("pub_year").alias("first_review_year"),
            F.max("pub_year").alias("last_review_year"),
        )
    )


def artist_streams(w: Warehouse, places: int | None = None) -> DataFrame:
    """Listening summary per track artist."""
    metric = Metric(places)
    total, mean = metric.total, metric.mean
    return w.tracks.groupBy("artist").agg(
        F.count("*").alias("track_count"),
        total(F.col("streams")).alias("total_streams"),
        mean(F.col("streams")).alias("avg_streams_per_track"),
        total(F.col("yt_views")).alias("total_yt_views"),
        mean(F.col("yt_views")).alias("avg_yt_views_per_track"),
        total(F.col("yt_likes")).alias("total_yt_likes"),
        total(F.col("yt_comments")).alias("total_yt_comments"),
        mean(F.col("danceability")).alias("avg_danceability"),
        mean(F.col("energy")).alias("avg_energy"),
        mean(F.col("valence")).alias("avg_valence"),
    )


def artist_mart(w: Warehouse, places: int | None = None) -> DataFrame:
    """One row per mapped artist: critic summary with the listening summary where there is one."""
    return artist_summary(w, places).join(artist_streams(w, places), "artist", "left")


VIEWS = {
    "vw_review_with_artist": review_with_artist,
    "vw_unmatched_artists": unmatched_artists,
    "vw_artist_coverage_by_year": coverage_by_year,
    "vw_artist_summary": artist_summary,
    "vw_artist_streams": artist_streams,
    "vw_artist_critics_vs_streams": artist_mart,
}


def register(w: Warehouse, tables: bool = True) -> list[str]:
    """(Re)create temporary views of every semantic view and, unless they are tables, the base tables."""
    frames = {TABLE_NAMES[f.name]: getattr(w, f.name) for f in fields(w)} if tables else {}
    frames |= {name: view(w) for name, view in VIEWS.items()}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
