"""Table scans: the driver's parquet tables, lake / warehouse tables, NDJSON batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table. Column pruning and filter pushdown reach the parquet reader
    through Catalyst, so callers just select / filter what they need."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Full warehouse/lake table scan with lower-case column names."""
    df = spark.table(name)
    return df.toDF(*[c.lower() for c in df.columns])


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
                corrupt_col: str | None = "_corrupt_record") -> DataFrame:
    """Scan a dated NDJSON batch with a declared schema (never inferred).

    Malformed lines are kept in ``corrupt_col`` (PERMISSIVE) so they can be quarantined with a
    reason instead of failing the job. ``multi_line=True`` reads one JSON document (array).
    """
    if corrupt_col and corrupt_col not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    r = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if multi_line:
        r = r.option("multiLine", "true")
    return r.json(path)


def batch_path(root: str, source: str, ds: str) -> str:
    """Dated batch location ``{root}/{source}/ds={ds}`` (one folder per run day)."""
    return f"{root.rstrip('/')}/{source}/ds={ds}"
