"""Staging, matching, dimension, checks, manifests and sources on small inputs."""

import hashlib
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from receptionmart import schemas
from receptionmart.errors import DataQualityError, MissingInputError, PublishConflictError
from receptionmart.functions import numbers
from receptionmart.operators import columns, manifest, quality
from receptionmart.operators.ranking import keep_first, ordered_slices, surrogate_key
from receptionmart.plans import dimension, jobs, matching, pipeline, staging
from receptionmart.sources import files, readers, writers


def names(spark, values, column="name"):
    return spark.createDataFrame([(v,) for v in values], f"{column} STRING")


def raw_reviews(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.REVIEWS_RAW)


GOOD = (1, "nick cave & the bad seeds", "t", "8.3", "1", "2004-09-20 00:00:00", "2004", "9", "20")


def test_stage_reviews(spark):
    typed, null_dates = staging.stage_reviews(raw_reviews(spark, GOOD, (2, "u2", "t", "0", "0", "bad", "2004", "9", "20")))
    assert null_dates == 1
    first = staging.dates_as_text(typed).filter("reviewid = 1").first()
    assert (first.score, first.pub_date, first.pub_year, first.best_new_music) == (8.3, "2004-09-20", 2004, 1)
    for score in ("10.1", "-1", None):
        with pytest.raises(DataQualityError):
            staging.stage_reviews(raw_reviews(spark, (*GOOD[:3], score, *GOOD[4:])))


@pytest.mark.parametrize("plays", ["Stream", "Streams"])
def test_clean_tracks(spark, plays):
    raw = spark.createDataFrame(
        [("x", "s1", "u", 5.0), ("x", "s1", "u", 5.0), ("y", None, "u", 1.0), (None, "s", "u", 1.0)],
        f"` Artist ` STRING, Track STRING, `Url Youtube` STRING, {plays} DOUBLE",
    )
    got = staging.clean_tracks(raw)
    assert got.columns == ["artist", "song", "streams"]
    assert [tuple(r) for r in got.collect()] == [("x", "s1", 5.0)]


def test_bridge(spark):
    reviews = spark.createDataFrame([(1, "Foo & Foo"), (1, "Foo"), (2, "ac/dc"), (3, None), (4, "a feat. bob")], "reviewid BIGINT, artist STRING")
    assert sorted(tuple(r) for r in staging.review_artists(reviews).collect()) == [(1, "Foo"), (4, ". bob")]


def test_universe(spark):
    bridge = spark.createDataFrame(
        [(1, "Drake"), (2, "Drake"), (3, "drake"), (4, "A & Drake"), (5, "Various Artists"), (6, "u2"), (7, "DRAKE")], "reviewid BIGINT, artist STRING"
    )
    got = {r.artist_norm: r for r in matching.artist_universe(bridge).collect()}
    assert (got["drake"].artist, got["drake"].n_reviews) == ("Drake", 3)
    assert got["various artists"].is_various and got["u2"].is_suspicious_token and not got["drake"].is_suspicious_token
    assert set(got) == {"drake", "a", "various artists", "u2"}


def test_candidates(spark):
    lists = spark.createDataFrame([('["Drake", "DRAKE", "Big Records"]', 1), ("a-ha; A.ha", 2), (None, 3)], "Artists STRING, other INT")
    single = spark.createDataFrame([("µ-Ziq",), ("...",)], "artist_name STRING")
    got = {r.artist_norm: r.artist_spotify for r in matching.candidates(matching.candidate_names([lists, single])).collect()}
    assert got == {"drake": "DRAKE", "a ha": "A.ha", "mu ziq": "µ-Ziq"}


@pytest.fixture(scope="module")
def mapped(spark):
    universe = spark.createDataFrame(
        [
            ("Drake", 5, "drake", False, False),
            ("a-ha", 2, "a-ha", False, False),
            ("The Big Red Band", 1, "the big red band", False, False),
            ("Alone", 1, "alone", False, False),
            ("Various Artists", 9, "various artists", True, False),
            ("u2", 3, "u2", False, True),
        ],
        schemas.UNIVERSE,
    )
    named = spark.createDataFrame(
        [("drake", "Drake"), ("a ha", "a-ha!"), ("the big red", "The Big Red"), ("u2", "U2"), ("various artists", "Various Artists")],
        "artist_norm STRING, artist_spotify STRING",
    )
    return universe, matching.artist_map(universe, named)


def test_artist_map(spark, mapped):
    got = {r.artist: (r.artist_spotify, r.match_type, r.score, r.spotify_artist_id) for r in mapped[1].collect()}
    assert got == {
        "Drake": ("Drake", "exact_norm", 1.0, None),
        "a-ha": ("a-ha!", "jaccard_token", 1.0, None),
        "The Big Red Band": ("The Big Red", "jaccard_token", 0.75, None),
        "Alone": (None, "", 0.0, None),
    }
    assert [r.artist for r in matching.map_order(mapped[1]).collect()] == ["Drake", "a-ha", "The Big Red Band", "Alone"]


def test_map_without_candidates(spark, mapped):
    empty = spark.createDataFrame([], "artist_norm STRING, artist_spotify STRING")
    got = matching.artist_map(mapped[0], empty).collect()
    assert len(got) == 4 and {(r.match_type, r.score, r.artist_spotify) for r in got} == {("none", 0.0, None)}


def test_published_pairs(spark):
    # (left, right, score, accepted) as published.
    cases = [
        ("cee-lo green", "CeeLo Green", 100, True),
        ("florence and the machine", "Florence + The Machine", 95, True),
        ("jhen aiko", "Jhené Aiko", 94, True),
        ("man man", "Method Man", 95, True),
        ("the pretenders", "Pretenders", 100, False),
        ("lv", "L.V.", 100, False),
        ("motrhead", "Motörhead", 94, False),
    ]
    got = matching.weighted_matches(names(spark, [c[0] for c in cases]), names(spark, [c[1] for c in cases] + ["Unrelated"]))
    assert sorted((r.left_name, r.right_name, r.score, r.accepted) for r in got.collect()) == sorted(cases)
    assert matching.accepted_pairs(got).columns == ["pitchfork_artist", "spotify_artist", "score"]
    assert {r.pf_clean for r in matching.review_queue(got).collect()} == {"pretenders", "lv", "motrhead"}


def test_blocked_name_is_queued(spark):
    got = matching.weighted_matches(names(spark, ["Soundtrack"]), names(spark, ["soundtrack"])).first()
    assert (got.score, got.accepted) == (100, False)


def test_dimension(spark, mapped):
    dim = dimension.artist_dimension(mapped[1])
    got = [(r.artist_key, r.artist_norm) for r in dim.orderBy("artist_key").collect()]
    assert got == [(1, "a-ha"), (2, "alone"), (3, "drake"), (4, "the big red band")]
    bridge = names(spark, ["Drake", "Drake", "a-ha", "Alone", "Unknown"], "artist")
    assert tuple(dimension.mapping_coverage(bridge, dim).first()) == (4, 2, 1, 1)


def test_dimension_rejects_blank_keys(spark):
    with pytest.raises(DataQualityError):
        dimension.artist_dimension(spark.createDataFrame([("x", " "), ("y", "y")], "artist STRING, artist_norm STRING"))


def test_best_per_key_and_defaults(spark):
    rows = [("p", "x", "1.0", 3), ("q", "x", "1.0", None), ("r", "x", "0.7", 9), ("s", "y", "bad", 1)]
    staged = dimension.staged_map(spark.createDataFrame(rows, "artist STRING, artist_norm STRING, score STRING, n_reviews BIGINT"))
    got = {r.artist_norm: (r.artist, r.score, r.match_type, r.spotify_artist_id) for r in dimension.best_per_key(staged).collect()}
    assert got == {"x": ("p", 1.0, "", None), "y": ("s", 0.0, "", None)}


def test_surrogate_keys_are_dense_and_ordered(spark):
    values = [f"k{(i * 7919) % 1000:04d}" for i in range(1000)]
    keyed = surrogate_key(names(spark, values, "k"), "k", "id", slice_rows=60)
    assert [(r.id, r.k) for r in keyed.orderBy("id").collect()] == list(enumerate(sorted(values), 1))
    assert surrogate_key(names(spark, ["one"], "k"), "k", "id").first().id == 1


def test_slices_of_skewed_values_are_even(spark):
    # Most values share a long beginning and lie close together.
    values = [f"{'z' * 30}{i:06d}" for i in range(9000)] + [f"{chr(97 + i % 20)}{i}" for i in range(1000)]
    sliced = ordered_slices(names(spark, values, "k").repartition(8), "k", 10)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 2000


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    best = keep_first(df, ["k"], [F.col("id").desc()])
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in best.collect()) == [97, 98, 99]


# --- checks -----------------------------------------------------------------------------------------------


def test_checks(spark):
    reviews = spark.createDataFrame([(1, 5.0), (2, 9.5)], "reviewid BIGINT, score DOUBLE")
    clean = spark.createDataFrame([(1, "foo"), (2, "u2")], schemas.BRIDGE)
    quality.assert_clean(clean, reviews)
    for bad, what in (((1, "s"), "token 's'"), ((1, "zz"), "zz"), ((999, "bar"), "without review")):
        with pytest.raises(DataQualityError, match=what):
            quality.assert_clean(clean.union(spark.createDataFrame([bad], schemas.BRIDGE)), reviews)
    doubled = clean.union(clean.filter("reviewid = 1"))
    assert [tuple(r) for r in quality.repeated_keys(doubled, ["reviewid", "artist"]).collect()] == [(1, "foo", 2)]
    assert tuple(quality.score_range(reviews).first()) == (5.0, 9.5)
    assert {r.tbl: r.n for r in quality.row_counts({"a": reviews, "b": doubled}).collect()} == {"a": 2, "b": 3}
    assert quality.blank_artists(names(spark, ["x", " ", None], "artist")).first()[0] == 2
    tracks = spark.createDataFrame([("a", "s"), ("a", None), (None, "s")], "artist STRING, song STRING")
    assert quality.incomplete_tracks(tracks).first()[0] == 2
    assert quality.short_tokens(clean, ()).count() == 1


# --- manifests --------------------------------------------------------------------------------------------


def entries(spark, rows):
    return spark.createDataFrame(rows, "table_name STRING, rows BIGINT, hash STRING")


def test_drift(spark):
    old = entries(spark, [("at_limit", 100, "h"), ("lost", 100, "h"), ("empty", 0, "h"), ("rehash", 5, "h"), ("same", 5, "h"), ("gone", 1, "h")])
    new = entries(spark, [("at_limit", 98, "g"), ("lost", 97, "g"), ("empty", 5, "g"), ("rehash", 5, "g"), ("same", 5, "h"), ("fresh", 1, "h")])
    drift = manifest.compare(old, new)
    got = {r.table_name: (r.status, r.delta_pct, r.hash_changed, r.fails) for r in drift.collect()}
    assert got["at_limit"] == ("changed", -2.0, True, False)
    assert got["lost"] == ("changed", -3.0, True, True)
    assert got["empty"] == ("changed", 0.0, True, False)
    assert got["rehash"] == ("changed", 0.0, True, False)
    assert got["same"] == ("same", 0.0, False, False)
    assert (got["gone"][0], got["fresh"][0]) == ("removed", "added")
    with pytest.raises(DataQualityError, match="lost"):
        manifest.require_no_loss(drift)
    manifest.require_no_loss(drift.filter("table_name <> 'lost'"))


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_fingerprint_ignores_layout(spark, method):
    df = spark.range(50).selectExpr("id", "CASE WHEN id % 7 > 0 THEN cast(id AS string) END AS s")
    a = manifest.fingerprint(df, "t", method).first()
    assert a == manifest.fingerprint(df.repartition(7).orderBy(F.col("id").desc()), "t", method).first()
    assert a.fingerprint != manifest.fingerprint(df.withColumn("s", F.lit("x")), "t", method).first().fingerprint


def test_export_and_manifest(spark, tmp_path):
    names(spark, ['say "hi", you', "b"], "artist").createOrReplaceTempView("artists")
    document = writers.export_tables(spark, ["artists", "absent"], str(tmp_path), "memory")
    assert document["missing_tables"] == ["absent"] and document["totals"]["rows_exported"] == 2
    again = manifest.entries(readers.read_manifest(spark, f"{tmp_path}/manifest.json")).first()
    assert (again.table_name, again.rows, len(again.hash)) == ("artists", 2, 64)
    assert json.loads((tmp_path / "manifest.json").read_text())["tables"]["artists"]["bytes"] == again.bytes > 0
    back = readers.read_csv(spark, f"{tmp_path}/artists.csv", "artist STRING")
    assert sorted(r.artist for r in back.collect()) == ["b", 'say "hi", you']
    assert manifest.totals(manifest.entries(readers.read_manifest(spark, f"{tmp_path}/manifest.json"))).first()["tables_exported"] == 1
    assert document["source_db_mtime"] is None


def test_export_tells_the_time_of_the_source(spark, tmp_path):
    writers.save_table(spark.range(5), "from_files", f"{tmp_path}/in")
    try:
        document = writers.export_tables(spark, ["from_files"], f"{tmp_path}/out", "files")
    finally:
        spark.sql("DROP TABLE from_files")
    written = sum(p.stat().st_size for p in (tmp_path / "out" / "from_files.csv").glob("*.csv"))
    newest = max(p.stat().st_mtime for p in (tmp_path / "in").glob("*.parquet"))
    assert document["totals"] == {"tables_exported": 1, "rows_exported": 5, "bytes_exported": written}
    assert abs(datetime.fromisoformat(document["source_db_mtime"]).timestamp() - newest) < 1
    assert readers.read_csv(spark, f"{tmp_path}/out/from_files.csv").columns == ["id"]


def test_files_are_hashed_in_parts(spark, tmp_path):
    content = bytes(range(256)) * 5000
    (tmp_path / "a b%20.bin").write_bytes(content)
    (tmp_path / "short.bin").write_bytes(b"x")
    listed = spark.read.format("binaryFile").load(str(tmp_path))
    got = {(r.bytes, r.sha256) for r in manifest.file_hashes(listed).collect()}
    assert got == {(len(c), hashlib.sha256(c).hexdigest()) for c in (content, b"x")}
    assert files.sha256_of(str(tmp_path / "a b%20.bin"), chunk=1000) == hashlib.sha256(content).hexdigest()


def test_published_versions(spark, tmp_path, monkeypatch):
    def values():
        return [r.k for r in spark.table("published").collect()]

    try:
        writers.save_table(names(spark, ["plain"], "k"), "published", f"{tmp_path}/plain")
        first = writers.publish_version(names(spark, ["one"], "k"), "published", str(tmp_path))
        assert values() == ["one"] and writers.live_version(spark, "published") == first
        with monkeypatch.context() as stop:
            stop.setattr(writers, "_switch", lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                writers.publish_version(names(spark, ["stopped"], "k"), "published", str(tmp_path))
        assert values() == ["one"]
        with monkeypatch.context() as other:
            save = writers.save_table

            def save_late(*args):
                save(*args)
                spark.sql(f"ALTER VIEW published SET TBLPROPERTIES ('{writers.VERSION}' = 'theirs')")

            other.setattr(writers, "save_table", save_late)
            with pytest.raises(PublishConflictError):
                writers.publish_version(names(spark, ["late"], "k"), "published", str(tmp_path))
        assert values() == ["one"]
        spark.sql(f"ALTER VIEW published SET TBLPROPERTIES ('{writers.VERSION}' = '{first}')")
        writers.publish_version(names(spark, ["two"], "k"), "published", str(tmp_path))
        assert values() == ["two"] and len(writers.drop_versions(spark, "published")) == 3
        assert writers.roll_back(spark, "published") == first and values() == ["one"]
        with pytest.raises(MissingInputError):
            writers.roll_back(spark, "published")
    finally:
        spark.sql("DROP VIEW IF EXISTS published")
        writers.drop_versions(spark, "published")


@pytest.mark.parametrize(
    "form, dates",
    [
        (None, ["2010-01-31", "2010-02-01 10:00:00"]),
        ("M/d/yyyy", ["01/31/2010", "2/1/2010"]),
        ("d/M/yyyy", ["31/01/2010", "1/2/2010"]),
        ("yyyyMMdd", ["20100131", "20100201"]),
        ("d.M.yyyy", ["31.1.2010", "01.02.2010"]),
        ("MMMM d, yyyy", ["January 31, 2010", "February 1, 2010"]),
        ("d MMM yyyy", ["31 Jan 2010", "1 Feb 2010"]),
    ],
)
def test_date_form_is_found(spark, form, dates):
    df = spark.createDataFrame([(d,) for d in [*dates, "unknown", "", None]], "d STRING")
    assert numbers.date_form(df, "d") == form
    got = [r.d for r in df.select(numbers.date_or_null(F.col("d"), form).alias("d")).collect()]
    assert got == [date(2010, 1, 31), date(2010, 2, 1), None, None, None]


# --- sources ----------------------------------------------------------------------------------------------


def test_missing_inputs_fail(spark, tmp_path):
    with pytest.raises(MissingInputError):
        readers.read_csv(spark, f"{tmp_path}/none.csv")
    with pytest.raises(MissingInputError):
        readers.require_table(spark, "no_such_table")
    (tmp_path / "a.csv").write_text("x\n1\n")
    with pytest.raises(MissingInputError, match="artist"):
        readers.read_csv(spark, f"{tmp_path}/a.csv", "artist STRING")


def test_candidate_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text("ID,Artist_Name,plays\n1,Foo,3\n")
    (tmp_path / "two.csv").write_text('artists,artist\n"[""A"", ""B""]",C\n')
    (tmp_path / "three.csv").write_text("nothing,here\n1,2\n")
    (tmp_path / "empty.csv").write_text("")
    frames = readers.read_candidate_files(spark, [str(tmp_path), str(tmp_path / "absent")])
    assert sorted(tuple(f.columns) for f in frames) == [("Artist_Name",), ("artists", "artist")]
    assert sorted(r.name for r in matching.candidate_names(frames).collect()) == ["A", "B", "C", "Foo"]


def test_many_candidate_files_in_few_scans(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"{i}.csv").write_text(("artist,n\n" if i % 2 else "n,Artists,n\n") + (f"a{i},1\n" if i % 2 else f"1,b{i},2\n"))
    (tmp_path / "bad.csv").write_bytes(b"\xff\xfeartist\n")
    frames, skipped = readers.scan_candidates(spark, [str(tmp_path)])
    assert len(frames) == 2 and [p.rsplit("/", 1)[-1] for p in skipped] == ["bad.csv"]
    assert matching.candidate_names(frames).count() == 200


def test_folder_and_catalog(spark, tmp_path):
    (tmp_path / "plays.csv").write_text("artist,n\nNA,3\n,4\n")
    loaded = readers.load_folder(spark, str(tmp_path))
    assert list(loaded) == ["plays"] and "plays" in readers.table_names(spark)
    assert [tuple(r) for r in spark.sql("SELECT artist, n FROM plays ORDER BY n").collect()] == [("NA", 3), (None, 4)]
    assert readers.sample(spark, "plays", 1).count() == 1
    assert [tuple(r)[1:4] for r in readers.columns_of(loaded["plays"], "plays").orderBy("position").collect()] == [(0, "artist", "string"), (1, "n", "int")]


def test_sinks_replace(spark, tmp_path):
    df = names(spark, ["a"], "artist")
    for _ in range(2):
        writers.write_parquet(df, f"{tmp_path}/p")
        writers.write_csv(df, f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 1 and readers.read_csv(spark, f"{tmp_path}/c").count() == 1


def test_column_operators(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "` My Col` INT, b DOUBLE, C STRING")
    headed = columns.normalize_headers(df)
    assert headed.columns == ["my_col", "b", "c"] and columns.numeric_columns(headed) == ["my_col", "b"]
    assert columns.with_defaults(columns.keep_present(headed, ["b", "zz"]), {"zz": (1, "int"), "b": (0, "int")}).columns == ["b", "zz"]


# --- whole pipeline ---------------------------------------------------------------------------------------


def test_pipeline(spark):
    reviews = raw_reviews(spark, GOOD, (2, "Drake feat. Rihanna", "u", "6", "0", "2010-01-02", "2010", "1", "2"), (3, "U2", "v", "7.5", "0", "x", "2011", "1", "1"))
    tracks = spark.createDataFrame(
        [("Drake", "s1", 100.0), ("Drake", "s2", 50.0), ("The Bad Seeds", "s3", 7.0)], "Artist STRING, Track STRING, Stream DOUBLE"
    )
    for c in ("Danceability", "Energy", "Loudness", "Valence", "Views", "Likes", "Comments"):
        tracks = tracks.withColumn(c, F.lit(1.0))
    w = pipeline.build_warehouse(reviews, tracks, [])
    from receptionmart.plans.views import artist_mart

    got = {r.artist: (r.review_count, r.avg_score, r.track_count, r.total_streams) for r in artist_mart(w).collect()}
    assert got == {"Drake": (1, 6.0, 2, 150.0), "The Bad Seeds": (1, 8.3, 1, 7.0)}


def test_published_tables(spark, tmp_path, mapped):
    folder = str(tmp_path)
    reviews, _ = staging.stage_reviews(raw_reviews(spark, GOOD, (2, "Drake", "u", "6", "0", "2010-01-02", "2010", "1", "2")))
    bridge = spark.createDataFrame([(1, "nick cave"), (2, "Drake"), (2, "Drake"), (9, "Drake")], schemas.BRIDGE)
    try:
        report = jobs.load_reviews_and_bridge(reviews, bridge, folder)
        assert (report.reviews, report.bridge_rows, report.duplicate_pairs, report.orphans) == (2, 4, 1, 1)
        assert report.top_artists == [("Drake", 3), ("nick cave", 1)]
        assert jobs.publish_dimension(mapped[1], folder).count() == 4
        with pytest.raises(DataQualityError):
            jobs.publish_dimension(mapped[1].withColumn("artist_norm", F.lit("")), folder)
        assert spark.table("dim_artist").count() == 4
        with pytest.raises(MissingInputError):
            jobs.open_warehouse(spark)
        tracks = spark.createDataFrame([("Drake", "s", *[1.0] * 8)], schemas.TRACKS)
        writers.save_table(tracks, "spotify_youtube_clean", f"{folder}/tracks")
        jobs.open_warehouse(spark)
        assert [r.artist for r in spark.table("vw_artist_critics_vs_streams").collect()] == ["Drake"]
        _, described, few = jobs.inspect(spark, "pitchfork_reviews", 1)
        assert few.count() == 1 and described.filter("column_name = 'pub_date'").first().dtype == "string"
    finally:
        for table in ("pitchfork_reviews", "pitchfork_review_artists", "spotify_youtube_clean"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql("DROP VIEW IF EXISTS dim_artist")
        writers.drop_versions(spark, "dim_artist")


def test_published_pairs_on_disk(spark, tmp_path):
    accepted, queued = jobs.publish_pairs(names(spark, ["Drake", "lv"], "artist"), names(spark, ["drake", "L.V."], "artist"), str(tmp_path))
    assert [tuple(r) for r in accepted.collect()] == [("Drake", "drake", 100)]
    assert readers.read_csv(spark, f"{tmp_path}/artist_review_queue").first().pf_clean == "lv"


def test_sources_without_artists_and_flags_with_decimals(spark):
    assert matching.candidate_names([]).count() == 0
    raw = spark.createDataFrame([("1.0", "2004"), ("0", "1999.0"), (None, None)], "flag STRING, year STRING")
    got = raw.select(numbers.whole_number(F.col("flag"), "tinyint").alias("f"), numbers.whole_number(F.col("year"), "smallint").alias("y")).collect()
    assert [tuple(r) for r in got] == [(1, 2004), (0, 1999), (None, None)]
    with pytest.raises(Exception, match="whole"):
        raw.select(numbers.whole_number(F.lit("1.5"), "tinyint")).collect()


def test_staged_files(spark, tmp_path):
    tracks = spark.createDataFrame([("nick cave & the bad seeds", "s", 1.0), ("the u2", "t", 2.0)], "Artist STRING, Track STRING, Stream DOUBLE")
    paths = jobs.stage_files(raw_reviews(spark, GOOD, (2, "the u2", *GOOD[2:])), tracks, [], str(tmp_path))
    assert tuple(paths) == jobs.STAGED
    rows = {name: readers.read_csv(spark, path, multiline=True).count() for name, path in paths.items()}
    assert rows["reviews"] == rows["tracks"] == 2 and rows["artist_map"] == rows["artist_universe"] > 0
    scores = [float(r.score) for r in readers.read_csv(spark, paths["artist_map"]).collect()]
    assert scores == sorted(scores, reverse=True)


def test_drift_job(spark, tmp_path):
    names(spark, ["a", "b"], "artist").createOrReplaceTempView("drifting")
    writers.export_tables(spark, ["drifting"], str(tmp_path / "old"), "memory")
    names(spark, ["a"], "artist").createOrReplaceTempView("drifting")
    writers.export_tables(spark, ["drifting"], str(tmp_path / "new"), "memory")
    old, new = (f"{tmp_path}/{version}/manifest.json" for version in ("old", "new"))
    assert [r.status for r in jobs.check_drift(spark, old, old).collect()] == ["same"]
    assert jobs.check_drift(spark, new, old).first().delta_rows == 1
    with pytest.raises(DataQualityError, match="lost"):
        jobs.check_drift(spark, old, new)


def test_large_csv_is_read_in_parts(spark, tmp_path):
    path = tmp_path / "large.csv"
    path.write_text("artist,n\n" + "".join(f"a{i},{i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert readers.read_csv(spark, str(path)).rdd.getNumPartitions() > 4
        assert readers.read_csv(spark, str(path), multiline=True).rdd.getNumPartitions() == 1
        assert readers.read_csv(spark, str(path), "artist STRING, n INT").count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_shuffles_of_the_dimension_do_not_stay_on_disk(spark):
    """Nor do those of its checks; what numbers the rows runs when they are read."""

    def shuffled():
        listed = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().iterator()
        names = set()
        while listed.hasNext():
            names.add(listed.next().name())
        return {n for n in names if n.startswith("shuffle_")}

    mapped = spark.range(200).select(F.col("id").cast("string").alias("artist"), (F.col("id") % 50).cast("string").alias("artist_norm"))
    before = shuffled()
    dim = dimension.artist_dimension(mapped)
    assert not shuffled() - before
    assert dim.count() == 50
