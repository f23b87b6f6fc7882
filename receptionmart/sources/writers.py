"""Sinks. All of them replace what is there."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import MissingInputError, PublishConflictError
from ..operators import manifest as m
from .readers import split_expected

# Properties of a published name: the version it shows and the one before.
VERSION, PREVIOUS = "published.version", "published.previous"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table, in the warehouse folder or at a path of its own."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def live_version(spark: SparkSession, name: str) -> str | None:
    """The version a published name shows; None if nothing is published under it."""
    return _property(spark, name, VERSION)


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(key) or None


def _switch(spark: SparkSession, name: str, version: str, previous: str | None) -> None:
    properties = f"'{VERSION}' = '{version}', '{PREVIOUS}' = '{previous or ''}'"
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS SELECT * FROM {name}_{version}")


def publish_version(df: DataFrame, name: str, path: str | None = None) -> str:
    """Write a new version in full, then let ``name`` show it in one step; returns the version.

    ``name`` is a view over the live version's table, so until the switch, and when anything fails before it, readers see the
    old rows. Raises when somebody else published in the meantime; the new version is then written but not live. A plain
    table of that name, from before versions, becomes the first version. Older versions stay for ``roll_back`` until
    ``drop_versions``. With ``path`` each version gets a folder of its own below it.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    before = live_version(spark, name)
    save_table(df, f"{name}_{version}", f"{path}/{version}" if path else None)
    if live_version(spark, name) != before:
        raise PublishConflictError(f"{name} was published by somebody else; version {version} is not live")
    if before is None and spark.catalog.tableExists(name):
        before = uuid.uuid4().hex
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}_{before}")
    _switch(spark, name, version, before)
    return version


def roll_back(spark: SparkSession, name: str) -> str:
    """Show the version before the live one again; returns it."""
    previous = _property(spark, name, PREVIOUS)
    if previous is None or not spark.catalog.tableExists(f"{name}_{previous}"):
        raise MissingInputError(f"{name} has no earlier version")
    _switch(spark, name, previous, None)
    return previous


def drop_versions(spark: SparkSession, name: str, keep_previous: bool = True) -> list[str]:
    """Drop the tables of versions that are neither live nor, unless told otherwise, the one before; returns their names."""
    kept = {f"{name}_{v}".lower() for v in (live_version(spark, name), _property(spark, name, PREVIOUS) if keep_previous else None) if v}
    is_version = re.compile(re.escape(name.lower().rsplit(".", 1)[-1]) + "_[0-9a-f]{32}")
    database = name.rsplit(".", 1)[0] if "." in name else None
    gone = []
    for table in spark.catalog.listTables(database):
        full = f"{database}.{table.name}" if database else table.name
        if is_version.fullmatch(table.name.lower()) and full.lower() not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            gone.append(full)
    return gone


def _write_text(spark: SparkSession, path: str, content: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    try:
        out.write(bytearray(content.encode("utf-8")))
    finally:
        out.close()


def export_tables(spark: SparkSession, expected: Sequence[str], folder: str, source: str) -> dict:
    """Export the expected tables that exist as CSV and write a manifest last.

    Row counts and the newest time of the source files are observed while a table is written, bytes come from the listing
    of what was written, and hashes are taken by tasks over the written files. The manifest holds one entry per table, so
    it is small and is put together on the driver. The time is NULL where the tables are views or not read from files.
    """
    present, missing = split_expected(spark, expected)
    tables: dict[str, dict] = {}
    changed = []
    for name in present:
        path = f"{folder}/{name}.csv"
        rows, newest = _write_observed(spark.table(name), path)
        tables[name] = {"csv_path": path, "rows": rows, **_written(spark, path)}
        changed.append(newest)
    document = {
        "source_db": source,
        "source_db_mtime": max((t for t in changed if t is not None), default=None),
        "exported_at": spark.range(1).select(F.date_format(F.current_timestamp(), TIME_FORMAT)).first()[0],
        "tables": tables,
        "missing_tables": missing,
        "totals": {
            "tables_exported": len(tables),
            "rows_exported": sum(t["rows"] for t in tables.values()),
            "bytes_exported": sum(t["bytes"] for t in tables.values()),
        },
        "notes": ["sha256 is over the sorted hashes of the exported part files; keep the manifest to detect drift."],
    }
    _write_text(spark, f"{folder}/manifest.json", json.dumps(document, indent=2, ensure_ascii=False))
    return document


def _write_observed(df: DataFrame, path: str) -> tuple[int, str | None]:
    """Write CSV; returns the rows written and the newest modification time of the files they were read from."""
    stamp, watch = f"_{uuid.uuid4().hex}", Observation()
    try:
        stamped = df.withColumn(stamp, F.col("_metadata.file_modification_time").cast("timestamp"))
    except AnalysisException:
        # A view, or not read from files.
        stamped = df.withColumn(stamp, F.lit(None).cast("timestamp"))
    newest = F.date_format(F.max(stamp), TIME_FORMAT)
    write_csv(stamped.observe(watch, F.count(F.lit(1)).alias("rows"), newest.alias("newest")).drop(stamp), path)
    return watch.get["rows"], watch.get["newest"]


def _written(spark: SparkSession, path: str) -> dict:
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    # One hash per part file, so the group is as small as the list of files.
    whole = m.file_hashes(parts).agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256).alias("sha256")
    ).first()
    return {"bytes": whole["bytes"], "sha256": whole["sha256"]}
