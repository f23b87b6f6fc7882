"""The ring, the archives, and the registered queries."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import corpus_pipeline
import __spark_entry__
from receptionmart.llm import ring, warc

SF = "/root/testdata/sf0.001"


def rows(spark, n):
    r = random.Random(n)
    data = [(r.randrange(10**9), "t" * r.randrange(50), 1) for _ in range(n)] + [(None, None, 1), (7, "same", 1), (7, "same", 1)]
    return spark.createDataFrame(data, "doc_id long, text string, shard int"), data


def test_ring_is_balanced_and_gapless(spark):
    df, data = rows(spark, 997)
    got = ring.assign(df, 40).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == len(data) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    want = Counter((i, len(t or "") + 16, zlib.crc32((t or "").encode())) for i, t, _ in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert ring.assign(df.limit(0), 40).collect() == []


def test_ring_flow_is_what_single_rows_do():
    """Rows sent one by one, round by round, end in the same shards."""
    r = random.Random(2)
    counts = {r.randrange(ring.CELLS): r.randrange(1, 9) for _ in range(200)} | {5: 300}
    shards, replicas, total = 7, 16, None
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    places = ring.ring_places(shards, replicas)
    waiting = [[c, i, ring.place_of_cell(places, c)] for c in sorted(counts) for i in range(counts[c])]
    want = {}
    while waiting:
        again = []
        for c, i, p in waiting:
            s = places[p][1]
            if room[s]:
                room[s] -= 1
                want[c, i] = s
            else:
                again.append([c, i, (p + 1) % len(places)])
        waiting = again
    got = {(c, i): s for c, a, b, s, _ in ring.flow(counts, shards, replicas) for i in range(a, b)}
    assert got == want


def test_one_more_shard_moves_little(spark):
    df, _ = rows(spark, 3000)
    df = df.filter("doc_id > 7")
    one, two = ({r["doc_id"]: r["shard"] for r in ring.assign(df, n).collect()} for n in (40, 41))
    assert sum(one[i] != two[i] for i in one) < 0.6 * len(one)


def test_archives_round_trip(spark, tmp_path):
    bodies = ["<p>a</p>", "x\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n", "é", "", None, "x" * 200_000] + ["same"] * 9 + ["<p>a</p>"]
    data = [(i if i != 8 else None, f"http://h/{i}\r\nx: y", b, "z") for i, b in enumerate(bodies)] + [(0, "http://h/0", "<p>a</p>", "z")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, row string")
    warc.write_archives(pages, str(tmp_path / "w"))
    records = warc.read_archives(spark, str(tmp_path / "w")).cache()
    assert records.count() == 3 * len(data)
    got = [r.asDict(True) for r in warc.assemble(records).collect()]
    assert len(got) == len(data) and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in got)
    page = lambda r: r["metadata"][0]["page_id"]
    by_id = {r["response"]["record_id"]: r for r in got}
    first = {}
    for r in got:
        answer = r["response"]
        if answer["record_type"] == "response":
            assert hashlib.sha1(answer["payload"]).digest() == base64.b32decode(answer["payload_digest"])
            first[bytes(answer["payload"])] = page(r)
        else:
            origin = by_id[answer["refers_to"]]["response"]
            assert (origin["payload_digest"], origin["payload_bytes"]) == (answer["payload_digest"], answer["payload_bytes"])
    assert first == {b"<p>a</p>": 0, bodies[1].encode(): 1, "é".encode(): 2, b"": 3, b"x" * 200_000: 5, b"same": 6}
    records.unpersist()


def test_records_that_lead_nowhere(spark):
    data = [("a", "response", []), ("b", "request", ["a"]), ("c", "metadata", ["b"]), ("d", "metadata", ["zz"]), ("e", "request", None)]
    got = {r["capture_id"]: r for r in warc.assemble(spark.createDataFrame(data, "record_id string, record_type string, concurrent_to array<string>")).collect()}
    assert sorted(got) == ["a", "d", "e"] and got["d"]["response"] is None
    assert [x["record_id"] for x in got["a"]["metadata"]] == ["c"]


def test_registered_queries_and_pipeline(spark):
    names = set(__spark_entry__.queries())
    assert {f"op{i}_" for i in range(1, 11)} <= {n.split("_")[0] + "_" for n in names} and "pipeline" in names
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == docs.columns and 0 < out.count() <= left.count()
        left = out
    ids = {r["doc_id"] for r in left.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == ids
