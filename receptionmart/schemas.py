"""Declared schemas of the inputs and tables, as DDL."""

from __future__ import annotations

REVIEWS_RAW = (
    "reviewid BIGINT, artist STRING, title STRING, score STRING, best_new_music STRING, "
    "pub_date STRING, pub_year STRING, pub_month STRING, pub_day STRING"
)
REVIEWS = (
    "reviewid BIGINT, artist STRING, title STRING, score DOUBLE, best_new_music TINYINT, "
    "pub_date DATE, pub_year SMALLINT, pub_month TINYINT, pub_day TINYINT"
)
BRIDGE = ("reviewid BIGINT, artist STRING")
TRACKS = (
    "artist STRING, song STRING, danceability DOUBLE, energy DOUBLE, loudness DOUBLE, valence DOUBLE, "
    "yt_views DOUBLE, yt_likes DOUBLE, yt_comments DOUBLE, streams DOUBLE"
)
UNIVERSE = (
    "artist STRING, n_reviews BIGINT, artist_norm STRING, is_various BOOLEAN, is_suspicious_token BOOLEAN"
)
ARTIST_MAP = (
    "artist STRING, artist_norm STRING, n_reviews BIGINT, artist_spotify STRING, match_type STRING, "
    "score DOUBLE, spotify_artist_id STRING"
)
MANIFEST = (
    "source_db STRING, source_db_mtime STRING, exported_at STRING, "
    "tables MAP<STRING, STRUCT<csv_path: STRING, rows: BIGINT, bytes: BIGINT, sha256: STRING>>, "
    "missing_tables ARRAY<STRING>, "
    "totals STRUCT<tables_exported: BIGINT, rows_exported: BIGINT, bytes_exported: BIGINT>, notes ARRAY<STRING>"
)
