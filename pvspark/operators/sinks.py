"""Sinks and table management.

Writes are DataFrameWriter jobs (parallel, one file set per task) - never row-at-a-time inserts or
frames collected to a client.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pvspark.session import remove_path, shuffles_dropped
from pvspark.sources.tables import batch_path, read_ndjson

# --- fixed values: published (warehouse) schemas -------------------------------------------
# The reference's warehouse schema drops the three outcome flags (hospitalization, death,
# disability) that the marts need; the published schema here keeps them.
REPORTS_SCHEMA = [("report_id", "VARCHAR"), ("drug_name", "VARCHAR"), ("reaction", "VARCHAR"),
                  ("severity", "INTEGER"), ("age", "INTEGER"), ("weight", "FLOAT"), ("report_date", "DATE"),
                  ("age_group", "VARCHAR"), ("is_serious", "BOOLEAN"), ("hospitalization", "INTEGER"),
                  ("death", "INTEGER"), ("disability", "INTEGER"), ("ingestion_ts", "TIMESTAMP")]
ARTICLES_SCHEMA = [("article_id", "VARCHAR"), ("title", "VARCHAR"), ("abstract", "VARCHAR"),
                   ("publish_date", "DATE"), ("drug_name", "VARCHAR"), ("abstract_length", "INTEGER"),
                   ("publish_year", "INTEGER"), ("ingestion_ts", "TIMESTAMP")]
POSTS_SCHEMA = [("post_id", "VARCHAR"), ("subreddit", "VARCHAR"), ("title", "VARCHAR"), ("body", "VARCHAR"),
                ("score", "INTEGER"), ("drug_mentions", "VARCHAR"), ("drug_list", "VARCHAR"),
                ("created_utc", "TIMESTAMP"), ("body_length", "INTEGER"), ("hour_of_day", "INTEGER"),
                ("ingestion_ts", "TIMESTAMP")]
LABELS_SCHEMA = [("drug_id", "VARCHAR"), ("brand_name", "VARCHAR"), ("generic_name", "VARCHAR"),
                 ("warnings", "VARCHAR"), ("interactions", "VARCHAR"), ("has_interactions", "BOOLEAN"),
                 ("warnings_length", "INTEGER"), ("ingestion_ts", "TIMESTAMP")]
# Warehouse type -> Spark type (TIMESTAMP is a wall-clock time without zone).
SPARK_TYPES = {"VARCHAR": "string", "INTEGER": "int", "FLOAT": "float", "DOUBLE": "double", "DATE": "date",
               "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}
# Router: the append target while the trial is at most 30 days old, then the truncating one.
TRIAL_DAYS = 30
TARGETS = ("append", "overwrite")
# ------------------------------------------------------------------------------------------


def _to_spark_value(c: Column, t: str) -> Column:
    if t == "VARCHAR":
        # arrays are published as CSV text
        return c
    return c.try_cast(SPARK_TYPES[t])


def project_to_schema(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Exactly the declared columns, cast to the declared types; absent columns are NULL,
    extra columns are dropped. Array columns become CSV text for VARCHAR targets."""
    types = dict(df.dtypes)
    cols = []
    for name, t in schema:
        if name not in df.columns:
            cols.append(F.lit(None).cast(SPARK_TYPES[t]).alias(name))
            continue
        c = F.col(name)
        if t == "VARCHAR" and types[name].startswith("array"):
            c = F.concat_ws(",", c)
        elif t == "VARCHAR":
            c = c.cast("string")
        else:
            c = _to_spark_value(c, t)
        cols.append(c.alias(name))
    return df.select(*cols)


def publish(df: DataFrame, target: str, schema: list[tuple[str, str]], mode: str = "overwrite",
            as_table: bool = False) -> None:
    """K4 (``append``: create if missing, append) / K5 (``overwrite``: truncate and load)."""
    if mode not in TARGETS:
        raise ValueError(f"mode must be one of {TARGETS}")
    w = project_to_schema(df, schema).write.mode(mode)
    if as_table:
        w.saveAsTable(target)
    else:
        w.parquet(target)


def choose_target(target: str, start: dt.date | None = None, today: dt.date | None = None) -> str:
    """K6: explicit target, or ``auto`` = append while (today - start) <= 30 days, else overwrite."""
    t = (target or "").lower()
    if t == "auto":
        if start is None:
            raise ValueError("auto target needs the trial start date")
        today = today or dt.date.today()
        return TARGETS[0] if (today - start).days <= TRIAL_DAYS else TARGETS[1]
    if t in TARGETS:
        return t
    raise ValueError("target must be append, overwrite, or auto")


def choose_target_col(start: Column, today: Column) -> Column:
    """K6 as a Column, for a table of (start, today) pairs."""
    return F.when(F.datediff(today, start) <= TRIAL_DAYS, F.lit(TARGETS[0])).otherwise(F.lit(TARGETS[1]))


def route(df: DataFrame, table: str, schema: list[tuple[str, str]], target: str = "auto",
          start: dt.date | None = None, today: dt.date | None = None, as_table: bool = False) -> str:
    """K6 -> K4 / K5: choose the sink and publish through it; returns the choice."""
    mode = choose_target(target, start, today)
    publish(df, table, schema, mode, as_table)
    return mode


def write_batch(df: DataFrame, root: str, source: str, ds: str) -> str:
    """K1: one dated NDJSON batch per (source, day); re-running the day overwrites it. The lines are compressed: they repeat
    every field name, and a task's file is read by one task again."""
    path = batch_path(root, source, ds)
    df.write.mode("overwrite").option("compression", "gzip").json(path)
    return path


def stage(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once and read back: rows that several sinks publish are computed once."""
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def to_key_value(df: DataFrame, key: str) -> DataFrame:
    """K7: keyed JSON records (``key`` as string, ``value`` = the whole row as JSON)."""
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None, v2: bool = False) -> None:
    """K3: create-or-replace a clean table (session catalog), or ``writeTo`` on a V2 catalog."""
    if v2:
        w = df.writeTo(name)
        if partition_by:
            w = w.partitionedBy(*[F.col(c) for c in partition_by])
        w.createOrReplace()
        return
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


RAW_DDL = {
    "faers_events": ("report_id STRING, drug_name STRING, reaction STRING, severity STRING, age STRING, "
                     "weight STRING, report_date STRING, hospitalization STRING, death STRING, disability STRING, "
                     "ingestion_ts TIMESTAMP, report_month STRING", "report_month"),
    "pubmed_articles": ("article_id STRING, title STRING, abstract STRING, publish_date STRING, drug_name STRING, "
                        "ingestion_ts TIMESTAMP, publish_month STRING", "publish_month"),
    "reddit_mentions": ("post_id STRING, subreddit STRING, title STRING, body STRING, score INT, "
                        "drug_mentions STRING, created_utc TIMESTAMP, ingestion_ts TIMESTAMP, created_date DATE",
                        "created_date"),
    "drug_labels": ("drug_id STRING, brand_name STRING, generic_name STRING, warnings STRING, interactions STRING, "
                    "ingestion_ts TIMESTAMP", None),
}


# Derived partition column of each raw table (a month or a day, never an unbounded key).
RAW_PARTITION_EXPR = {
    "faers_events": lambda: F.substring("report_date", 1, 6),
    "pubmed_articles": lambda: F.substring("publish_date", 1, 7),
    "reddit_mentions": lambda: F.to_date("created_utc"),
}


def bronze_load(spark: SparkSession, batch: str, table_path: str, table: str, ds: str) -> DataFrame:
    """A dated NDJSON batch -> the raw table, typed by the declared DDL (never
    inferred), partitioned by (ds, derived month/day). The whole ``ds=`` folder is replaced, so a
    rerun of a day leaves nothing of its earlier runs (months that have gone included) and other
    days survive. Lines that are not JSON objects of that shape go to ``quarantine_path`` of the
    day, not into the table. Returns the loaded table (all days)."""
    cols, part = RAW_DDL[table]
    data_cols = ", ".join(c for c in cols.split(", ") if not part or not c.startswith(part + " "))
    schema = spark.createDataFrame([], data_cols).schema
    # written once with the verdict, so the two outputs need one parse of the batch
    df = read_ndjson(spark, batch, schema).withColumn("ok", F.col("_corrupt_record").isNull())
    staged = f"{quarantine_path(table_path, ds)}"
    df.write.mode("overwrite").partitionBy("ok").parquet(staged)
    good = spark.read.schema(df.schema).parquet(staged).filter("ok").drop("ok", "_corrupt_record")
    w = (good.withColumn(part, RAW_PARTITION_EXPR[table]()) if part else good).write.mode("overwrite")
    (w.partitionBy(part) if part else w).parquet(f"{table_path}/ds={ds}")
    remove_path(spark, f"{staged}/ok=true")
    # read back with the declared types (no partition-value type inference: '0012' stays text)
    return spark.read.schema(f"{data_cols}, ds STRING" + (f", {part} {_ddl_type(cols, part)}" if part else "")) \
        .parquet(table_path)


def quarantine_path(table_path: str, ds: str) -> str:
    """Where ``bronze_load`` keeps the lines of a day that it could not parse."""
    return f"{table_path.rstrip('/')}_quarantine/ds={ds}"


def quarantined(spark: SparkSession, table_path: str, ds: str) -> DataFrame:
    """The raw text of a day's rejected lines."""
    return (spark.read.schema("_corrupt_record string, ok boolean").parquet(quarantine_path(table_path, ds))
            .filter("not ok").select(F.col("_corrupt_record").alias("line")))


def _ddl_type(cols: str, name: str) -> str:
    for c in cols.split(", "):
        n, t = c.split(" ", 1)
        if n == name:
            return t
    raise KeyError(name)


def create_raw_tables(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """K9: ``CREATE DATABASE / TABLE IF NOT EXISTS`` for the raw layer. Raw values stay strings
    (silver parses them); partitions are derived month / day columns, never the drug name
    (an unbounded number of small files). ``location`` places the database's folder."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    made = []
    for t, (cols, part) in RAW_DDL.items():
        p = f" PARTITIONED BY ({part})" if part else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({cols}) USING parquet{p}")
        made.append(f"{database}.{t}")
    return made


def register_views(tables: dict[str, DataFrame]) -> None:
    """Staging models are views over the clean tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
