"""Load manifests and drift between two of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DataQualityError
from ..sources import files

MAX_ROW_LOSS_PCT = 2.0
# Elements of number arrays are hashed as whole numbers of this unit, the same in every engine.
ARRAY_UNITS = 2**30
_FIELD_GAP = "\x1f"
_NULL_MARK = "\x00"


def row_hash(columns: list[Column], method: str) -> Column:
    """Hash of one row. ``md5`` is over the text form and can be recomputed by other engines."""
    if method == "xxhash64":
        return F.xxhash64(*columns).cast("decimal(38,0)")
    if method == "md5":
        parts = [F.coalesce(c.cast("string"), F.lit(_NULL_MARK)) for c in columns]
        return F.conv(F.substring(F.md5(F.concat_ws(_FIELD_GAP, *parts)), 1, 15), 16, 10).cast("decimal(38,0)")
    raise ValueError(f"unknown hash {method!r}")


def _text_ready(field: T.StructField) -> Column:
    """A column in a form whose text is the same in other engines."""
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        return F.array_join(F.transform(c, lambda x: F.floor(x.cast("double") * F.lit(float(ARRAY_UNITS))).cast("string")), ",", "-")
    return c


def fingerprint(df: DataFrame, table: str, method: str = "xxhash64") -> DataFrame:
    """One row (table_name, n_rows, n_columns, fingerprint) that ignores row order and file layout.

    Hashes are added up, so partial results combine on the way and nothing is sorted.
    """
    columns = [_text_ready(f) if method == "md5" else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count("*").alias("n_rows"),
        F.lit(len(columns)).alias("n_columns"),
        F.coalesce(F.sum(row_hash(columns, method)), F.lit(0)).cast("string").alias("fingerprint"),
    )


def table_manifest(tables: Mapping[str, DataFrame], method: str = "xxhash64") -> DataFrame:
    return reduce(DataFrame.unionByName, [fingerprint(df, name, method) for name, df in tables.items()])


def file_hashes(df_files: DataFrame) -> DataFrame:
    """Rows (path, bytes, sha256) of a frame read with the ``binaryFile`` format.

    Only the listing is read through that format. Each task opens its files itself and feeds the digest in parts, so a file
    may be larger than a row can be. Spark's listing leaves empty files out.
    """
    listed = df_files.select("path", F.col("length").alias("bytes"))
    return listed.mapInPandas(files.hashed, "path STRING, bytes BIGINT, sha256 STRING")


def sizes(df: DataFrame, table: str) -> DataFrame:
    """One row (table_name, rows, bytes); bytes are those of the values' text form with one byte between two columns."""
    texts = [F.coalesce(_text_ready(f).cast("string"), F.lit(_NULL_MARK)) for f in df.schema.fields]
    length = F.octet_length(F.concat_ws(_FIELD_GAP, *texts)).cast("bigint")
    return df.agg(F.lit(table).alias("table_name"), F.count("*").alias("rows"), F.coalesce(F.sum(length), F.lit(0)).alias("bytes"))


def totals(entries: DataFrame) -> DataFrame:
    """One row of totals over manifest entries with ``rows`` and ``bytes``."""
    return entries.agg(
        F.count("*").alias("tables_exported"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_exported"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_exported"),
    )


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """Drift between two manifests with columns (table_name, rows, hash), one row per table.

    ``status`` is added, removed, changed or same. The percentage is 0 when the old table was empty.
    """
    o, n = old.alias("o"), new.alias("n")
    delta = F.col("n.rows") - F.col("o.rows")
    pct = F.when(F.col("o.rows") != 0, delta / F.col("o.rows") * 100).when(F.col("o.rows") == 0, 0.0)
    hash_changed = ~F.col("o.hash").eqNullSafe(F.col("n.hash"))
    both = F.col("o.table_name").isNotNull() & F.col("n.table_name").isNotNull()
    return o.join(n, F.col("o.table_name") == F.col("n.table_name"), "full").select(
        F.coalesce("o.table_name", "n.table_name").alias("table_name"),
        F.col("o.rows").alias("old_rows"),
        F.col("n.rows").alias("new_rows"),
        delta.alias("delta_rows"),
        pct.alias("delta_pct"),
        F.when(both, hash_changed).alias("hash_changed"),
        F.when(F.col("o.table_name").isNull(), "added")
        .when(F.col("n.table_name").isNull(), "removed")
        .when((delta != 0) | hash_changed, "changed")
        .otherwise("same")
        .alias("status"),
        F.coalesce(both & (pct < -MAX_ROW_LOSS_PCT), F.lit(False)).alias("fails"),
    )


def require_no_loss(drift: DataFrame) -> None:
    """Raise when a table lost more rows than the policy allows; a changed hash alone does not."""
    failing = [r.table_name for r in drift.filter("fails").select("table_name").orderBy("table_name").collect()]
    if failing:
        raise DataQualityError(f"tables lost more than {MAX_ROW_LOSS_PCT} percent of their rows: {failing}")


def entries(manifest: DataFrame) -> DataFrame:
    """Rows (table_name, rows, bytes, hash) of a manifest read from JSON."""
    is_map = isinstance(manifest.schema["tables"].dataType, T.MapType)
    if not is_map:
        raise TypeError("read the manifest with its declared schema")
    return manifest.select(F.explode("tables").alias("table_name", "entry")).select(
        "table_name", "entry.rows", "entry.bytes", F.col("entry.sha256").alias("hash")
    )
