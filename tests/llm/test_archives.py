"""Names of archive rows and reading in small batches."""

import __spark_entry__
import duckdb
import pytest
from receptionmart.llm import queries, warc

SF = "/root/testdata/sf0.001"


def captures(records):
    return sorted(
        (r["page_id"] is None, r["page_id"], r["size"], r["kind"], r["payload"])
        for r in warc.assemble(records)
        .selectExpr("metadata[0].page_id page_id", "response.payload_bytes size", "response.record_type kind", "response.payload payload")
        .collect()
    )


@pytest.mark.parametrize("stored", [True, False])
def test_files_are_read_in_small_batches(spark, tmp_path, monkeypatch, stored):
    """Long payloads, some with the record separator, leave a file a few at a time."""
    data = [(i, f"http://h/{i}", ("\r\n\r\nWARC/1.1 " + "é" * i) * 50) for i in range(40)] + [(3, "http://h/3", None), (50, None, "é" * 40000)]
    spark.createDataFrame(data, "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    if not stored:
        pages = warc.with_file_rows(pages)
    warc.write_archives(pages, str(tmp_path / "w"), row_col=None if stored else "_row")
    monkeypatch.setattr(warc, "BATCH_BYTES", 5000)
    found = captures(warc.read_archives(spark, str(tmp_path / "w")).cache())
    want = sorted((False, i, len((t or "").encode()), "response", (t or "").encode()) for i, _, t in data)
    assert [(*r[:4], bytes(r[4])) for r in found] == want


def test_row_names_do_not_follow_splits(spark):
    pages = queries.table(spark, SF, "pages")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        names = []
        for size in ("10m", "20k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            frame = warc.with_file_rows(pages).select("page_id", "_row")
            names.append((sorted(map(tuple, frame.collect())), frame.rdd.getNumPartitions()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert names[0][0] == names[1][0] and names[0][1] != names[1][1]


def test_query_has_the_rows_of_its_sql(spark):
    got = __spark_entry__.queries()["op3_transactions"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()["op3_transactions"]).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
