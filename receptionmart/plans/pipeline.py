"""The jobs in order: raw inputs to warehouse, views and analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import quality
from ..session import materialize
from . import staging
from .dimension import artist_dimension
from .matching import artist_map, artist_universe, candidate_names, candidates
from .views import Warehouse


def build_warehouse(reviews_raw: DataFrame, tracks_raw: DataFrame, candidate_sources: Sequence[DataFrame]) -> Warehouse:
    """Stage, bridge, match and publish. Checks run before anything is returned."""
    reviews, _ = staging.stage_reviews(reviews_raw)
    tracks = staging.clean_tracks(tracks_raw)
    bridge = materialize(staging.review_artists(reviews))
    quality.assert_clean(bridge, reviews)
    named = candidates(candidate_names([tracks, *candidate_sources]))
    mapped = artist_map(artist_universe(bridge), named)
    return Warehouse(reviews, bridge, artist_dimension(mapped), tracks)
