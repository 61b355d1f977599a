"""Small helpers shared by the text operators: table scans, shared scratch tables, text rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pvspark.session import remove_path, scratch_path, shuffles_dropped

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; always through Spark's reader, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of the batches that go to Python tasks: whole texts are long, and a batch is in memory several times.
ARROW_ROWS, ARROW_BYTES = 500, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Spark send at most ARROW_ROWS rows and, unless a single row has more, ARROW_BYTES a batch to Python in this session."""
    for what, most in (("Records", ARROW_ROWS), ("Bytes", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.max{what}PerBatch"
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, str(most))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared ``spark.checkpoint.dir``, unique to this run."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    The lineage ends at files that every executor can read, so a lost executor costs at most the
    tasks it was running.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Scratch tables of one operator run: ``write`` makes one that ``clear`` removes, ``keep`` one that stays for the
    caller's result."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        self.paths.append(scratch(self.spark, name))
        return self.paths[-1]

    def _put(self, df: DataFrame, path: str) -> DataFrame:
        with shuffles_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return self._put(df, self.path(name))

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return self._put(df, scratch(self.spark, name))

    def clear(self) -> None:
        while self.paths:
            remove_path(self.spark, self.paths.pop())


def in_fold(doc_id: Column, buckets: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``, equals ``fold`` (null ids: never)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % buckets == fold, F.lit(False))


def text_key(c: Column) -> list[Column]:
    """``did`` and ``size``: 64-bit fingerprint and byte length of a text; null counts as empty."""
    t = F.coalesce(c, F.lit(""))
    return [F.xxhash64(t).alias("did"), F.octet_length(t).alias("size")]


def bucketed(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, str]:
    """``df`` as a table bucketed by ``keys`` in the shared scratch folder, and the table's name. Joins on the keys
    read the buckets in place. The caller ends it with ``drop_bucketed``."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        (df.write.option("compression", "zstd").option("path", scratch_path(spark, name))
         .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).saveAsTable(name))
    return spark.table(name), name


def drop_bucketed(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE {name}")
    remove_path(spark, scratch_path(spark, name))


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """The different texts (did, size, text, copies, least_id) as a table bucketed by did and size, and its name.

    Copies combine map-side, so a text that a third of all rows repeat reaches the shuffle once a task. Joins
    on did and size read the buckets in place and don't move texts again.
    """
    return bucketed(docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                                *text_key(F.col(text_col)))
                    .groupBy("did", "size").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"),
                                                F.min("id").alias("least_id")), ["did", "size"], "texts")
