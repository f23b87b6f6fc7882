"""Settings that keep one task's share of the work bounded."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receptionmart import workload
from receptionmart.plans import views
from receptionmart.session import configure
from receptionmart.sources import readers

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SMALLEST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


@pytest.fixture
def small_partitions(spark):
    configure(spark)
    kept = {k: spark.conf.get(k) for k in (ADVISORY, SMALLEST)}
    for k in kept:
        spark.conf.set(k, "16k")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_summary_is_spread_by_its_size_not_by_the_default_partitions(small_partitions):
    spark = small_partitions
    reviews = spark.range(40_000).select(
        F.col("id").alias("reviewid"), F.lit("t").alias("title"), F.lit(2000).alias("pub_year"), F.lit(1).alias("pub_month"), F.lit(5.0).alias("score")
    )
    name = F.concat(F.lit("a"), (F.col("id") % 20_000).cast("string")).alias("artist")
    artists = spark.range(20_000).select(name, name.alias("artist_spotify"), F.lit("exact_norm").alias("match_type"), F.lit(1.0).alias("score"))
    bridge = spark.range(40_000).select(F.col("id").alias("reviewid"), name)
    summary = views.artist_summary(views.Warehouse(reviews, bridge, artists, spark.range(0)))
    assert summary.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert summary.agg(F.sum("review_count")).first()[0] == 40_000


def test_texts_reach_python_in_batches_of_few_bytes(spark):
    @F.pandas_udf(T.LongType())
    def characters(values: pd.Series) -> pd.Series:
        return pd.Series([int(values.str.len().sum())] * len(values))

    texts = configure(spark).range(2_000, numPartitions=1).select(F.rpad(F.col("id").cast("string"), 10_000, "x").alias("text"))
    assert texts.select(characters("text").alias("n")).agg(F.max("n")).first()[0] < 6 * 2**20


def test_shuffles_are_cut_by_the_size_of_the_input(spark):
    cuts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(configure(spark, 10 * 2**30).conf.get(cuts)) == 5 * 2**10
    assert int(configure(spark).conf.get(cuts)) == 200


def test_scans_hold_no_credits_before_they_are_dealt(spark, tmp_path):
    lines = [(1, 7), (1, 7), (1, 8), (2, 7), (None, 7), (2, None), (2, None)]
    spark.createDataFrame(lines, "l_orderkey BIGINT, l_partkey BIGINT").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = workload.distinct_credits(configure(spark), str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "Part#000000007"), (1, "Part#000000008"), (2, "Part#000000007"), (None, "Part#000000007"), (2, None)], key=str
    )
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.rindex("HashAggregate") < plan.index("Exchange")


def test_folder_size_counts_all_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    (tmp_path / "y").write_bytes(b"123")
    assert readers.stored_bytes(spark, str(tmp_path)) == 8
