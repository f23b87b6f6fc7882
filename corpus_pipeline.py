"""A corpus pipeline over ``documents``: each stage is written as Parquet and read again by the next.

Stages: toxic documents go; lines of ten or more documents go; one document of each group of near duplicates stays (the
one with the smallest id); documents that hold benchmark passages go; what is left is packed into sequences.

Each row is a document: copies and leaks are dropped by row, so null and repeated ids neither save nor drop others. Rows
without words (null, empty or blank texts) are no copies of each other and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from receptionmart.llm import chosen_path, linededup, packing, queries, templates, toxicity, warc
from receptionmart.llm.common import anti_join, materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the threshold; rows of the held-out part are scored, never learned from."""
    scored = toxicity.score_toxicity(docs, queries.learnable_labels(spark, sf_dir), docs)
    return scored.filter("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their frequent lines; ``n_chars`` follows the text."""
    out = linededup.drop_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def with_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with a stored row id, since ids may be null or repeated."""
    return materialize(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays, the one with the smallest id (null ids last, then any one), and all rows without words."""
    rows = with_rows(docs)
    found = chosen_path.near_duplicates(rows, id_col="_row").select(F.col("doc_id").alias("_row"), "class_id")
    worded = rows.filter(F.col("text").rlike(r"[^\x09-\x0D\x20]")).select("_row", "doc_id")
    found = materialize(found.join(worded, "_row"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")
    first = found.groupBy("class_id").agg(F.min(order).alias("first")).select(F.col("first._row").alias("_row"))
    gone = materialize(found.join(first, "_row", "left_anti").select("_row"))
    return anti_join(rows, gone, "_row").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark passage, whatever their ids."""
    rows = with_rows(docs)
    hits = templates.find_leaks(rows, table(spark, sf_dir, "benchmark"), id_col="_row").select(F.col("doc_id").alias("_row"))
    return anti_join(rows, materialize(hits), "_row").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_texts(docs, queries.tokenizer_path(), queries.END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("chosen_path_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
#: Models and approximate joins have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    folder = warc.new_folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
