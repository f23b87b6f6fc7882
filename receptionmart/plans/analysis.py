"""Analysis of critic scores against listening figures, on the artist mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import positive_log10
from ..operators.stats import correlations, exact_quantiles

# --- fixed values ----------------------------------------------------------------------------------------
MIN_REVIEWS, MIN_TRACKS = 2, 5
HIGH_SCORE, LOW_SCORE = 8.5, 6.0
LOW_STREAMS_AT, HIGH_STREAMS_AT = 0.3, 0.7
CORRELATED = ("avg_score", "total_streams", "log10_total_streams")
CORRELATED_CORE = ("avg_score", "log10_total_streams")
EXPORTED = (
    "artist", "review_count", "avg_score", "min_score", "max_score", "first_review_year", "last_review_year",
    "track_count", "total_streams", "total_yt_views", "avg_danceability", "avg_energy", "avg_valence",
    "log10_total_streams",
)
# ---------------------------------------------------------------------------------------------------------


def analysis_frame(mart: DataFrame) -> DataFrame:
    """Artists with a score and streams, with log-scaled streams."""
    return (
        mart.na.drop(subset=["avg_score", "total_streams"])
        .filter(F.col("total_streams") > 0)
        .withColumns(
            {
                "log10_total_streams": F.log10("total_streams"),
                "log10_avg_streams_per_track": positive_log10(F.col("avg_streams_per_track")),
            }
        )
    )


def core_artists(frame: DataFrame, min_reviews: int = MIN_REVIEWS, min_tracks: int = MIN_TRACKS) -> DataFrame:
    return frame.filter((F.col("review_count") >= min_reviews) & (F.col("track_count") >= min_tracks))


def export_frame(core: DataFrame) -> DataFrame:
    return core.select(*EXPORTED)


def score_stream_correlation(frame: DataFrame) -> DataFrame:
    return correlations(frame, CORRELATED)


def core_correlation(core: DataFrame) -> DataFrame:
    return correlations(core, CORRELATED_CORE)


def _streams_quantile(core: DataFrame, probability: float):
    return exact_quantiles(core, ["log10_total_streams"], [probability]).select("quantile").scalar()


def underrated(core: DataFrame, high_score: float = HIGH_SCORE, at: float = LOW_STREAMS_AT) -> DataFrame:
    """Well reviewed artists in the lower part of the streams; sort by score when reading.

    ``core`` is read several times, so pass a materialized frame.
    """
    return core.filter((F.col("avg_score") >= high_score) & (F.col("log10_total_streams") <= _streams_quantile(core, at)))


def overrated(core: DataFrame, low_score: float = LOW_SCORE, at: float = HIGH_STREAMS_AT) -> DataFrame:
    """Poorly reviewed artists in the upper part of the streams; sort by streams when reading."""
    return core.filter((F.col("avg_score") <= low_score) & (F.col("log10_total_streams") >= _streams_quantile(core, at)))


def by_score(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("avg_score").desc_nulls_last(), F.col("artist"))


def by_streams(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("log10_total_streams").desc_nulls_last(), F.col("artist"))


def top(df: DataFrame, k: int, measure: str, name: str = "artist") -> DataFrame:
    """The k rows with the highest measure, ties by name."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(name).asc()).limit(k)
