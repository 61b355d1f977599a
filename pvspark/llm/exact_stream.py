"""Exact dedup as a stateful stream (DataFrame and Structured Streaming functions only).

``documents`` are read as a stream. Texts are compared after lower-casing A-Z. The stream keeps one state
row per distinct digest, for ever (no watermark, so nothing expires), in the RocksDB state store: the
SHA-256 digest as key; the largest doc_id as stable identifier, the content locator of that row (hash of
the file name, row number in the file) and the number of rows as value. State and offsets are
checkpointed in the shared folder, so a lost executor is replaced from there, and running the stream again
with the same ``checkpoint`` folder adds later files to the same state.

Afterwards the state is read back as a table (Spark's state data source) and joined with the documents.
Every hit (a row whose digest has more than one row) is compared byte for byte with the text at the
locator; rows that only share the digest are grouped anew by their full text.

Skew: the streaming aggregation combines map-side, so a digest that holds a third of all rows arrives as
one partial row a task. In the join, digests with more than ``HOT_SHARE`` of all rows (at most
1 / HOT_SHARE of them, hence a bounded broadcast) are salted over ``SALTS`` partitions.

Defined results: a null text counts as empty, and all empty texts are equal; of equal texts the row with
the largest doc_id stays (null ids lowest), and of fully repeated rows the one with the largest locator;
keep_id repeats the id of the row that stays; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pvspark.llm.common import ascii_lower, materialise, scratch

HOT_SHARE = 1 / 2000
HOT_LEAST = 512
SALTS = 64
#: Disk-backed state; no preallocated log files (4 MB for each of many small partitions).
STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = ascii_lower(F.col(text_col))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), norm.alias("norm"),
                       F.unhex(F.sha2(norm, 256)).alias("digest"),
                       F.struct(F.xxhash64(F.regexp_extract("_metadata.file_path", r"[^/]*$", 0)).alias("file"),
                                F.col("_metadata.row_index").alias("row")).alias("loc"))


def run_state(spark: SparkSession, path: str, checkpoint: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Drain the stream over ``path`` into keyed state and return the state: digest, keep, n.

    ``keep`` is struct(doc_id, loc) of the row that stays, ``n`` the rows with that digest.
    """
    schema = spark.read.parquet(path).schema
    path = path.rstrip("/")
    # written as a pattern that matches just this name: a plain path would have to be a folder
    stream = _keyed(spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]"), id_col, text_col)
    state = stream.groupBy("digest").agg(F.max(F.struct("doc_id", "loc")).alias("keep"),
                                         F.count(F.lit(1)).alias("n"))
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", checkpoint).start())
        query.awaitTermination()
        store = spark.read.format("statestore").load(checkpoint)
        values = store.schema["value"].dataType.names
        out = store.select("key.digest", F.col("value")[values[0]].alias("keep"),
                           F.col("value")[values[1]].alias("n"))
        return materialise(out, "dedup-state")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _salted(state: DataFrame, salts: Column) -> DataFrame:
    return state.withColumn("salt", F.explode(salts))


def exact_dedup(spark: SparkSession, path: str, checkpoint: str | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document under ``path``: doc_id, keep_id, group_size, kept, text_sha256, and its
    content locator (loc_file, loc_row)."""
    state = run_state(spark, path, checkpoint or scratch(spark, "dedup-stream"), id_col, text_col)
    total = state.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0].n
    bound = max(HOT_LEAST, int(total * HOT_SHARE))
    hot = state.filter(F.col("n") > bound).select("digest", F.lit(True).alias("hot"))
    docs = (_keyed(spark.read.parquet(path), id_col, text_col)
            .join(F.broadcast(hot), "digest", "left")       # at most 1 / HOT_SHARE rows
            .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("loc"), F.lit(SALTS)).cast("int"))
                        .otherwise(F.lit(0))).drop("hot"))
    salts = F.when(F.col("n") > bound, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    # texts move once; those of digests with a hit are kept for the comparison
    joined = materialise(docs.join(_salted(state, salts), ["digest", "salt"])
                         .select("doc_id", "loc", "digest", "salt", "keep", "n",
                                 F.when(F.col("n") > 1, F.col("norm")).alias("norm")), "dedup-joined")
    keeper = F.struct("doc_id", "loc").eqNullSafe(F.col("keep"))
    stored = _salted(joined.filter(keeper & (F.col("n") > 1)).select("digest", "n", F.col("norm").alias("stored")),
                     salts).drop("n")
    hits = (joined.filter("n > 1").join(stored, ["digest", "salt"], "left")
            .withColumn("same", F.col("norm").eqNullSafe(F.col("stored"))))
    checked = (hits.select("doc_id", "loc", "digest", "keep", "n", "same",
                           F.when(~F.col("same"), F.col("norm")).alias("other"))
               .unionByName(joined.filter("n = 1").select("doc_id", "loc", "digest", "keep", "n",
                                                          F.lit(True).alias("same"),
                                                          F.lit(None).cast("string").alias("other"))))
    checked = materialise(checked, "dedup-checked")
    # rows that share only the digest: grouped by their bytes (empty unless SHA-256 collides)
    odd = checked.filter(~F.col("same"))
    regrouped = odd.groupBy("digest", "other").agg(F.max(F.struct("doc_id", "loc")).alias("keep2"),
                                                   F.count(F.lit(1)).alias("n2"))
    fewer = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))
    out = (checked.filter("same").join(fewer, "digest", "left")
           .select("doc_id", "loc", "digest", "keep",
                   (F.col("n") - F.coalesce("less", F.lit(0))).alias("n"))
           .unionByName(odd.join(regrouped, ["digest", "other"])
                        .select("doc_id", "loc", "digest", F.col("keep2").alias("keep"), F.col("n2").alias("n"))))
    return out.select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                      F.struct("doc_id", "loc").eqNullSafe(F.col("keep")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"),
                      F.col("loc.file").alias("loc_file"), F.col("loc.row").alias("loc_row"))


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that an equal text replaces; all columns stay."""
    path = scratch(spark, "dedup-in")
    docs.write.parquet(path)
    gone = exact_dedup(spark, path, None, id_col, text_col).filter(~F.col("kept")).select(
        F.col("loc_file").alias("__gone_file"), F.col("loc_row").alias("__gone_row"))
    staged = spark.read.schema(docs.schema).parquet(path)
    file = F.xxhash64(F.regexp_extract("_metadata.file_path", r"[^/]*$", 0))
    return (staged.withColumns({"__file": file, "__row": F.col("_metadata.row_index")})
            .join(gone, (F.col("__file") == F.col("__gone_file")) & (F.col("__row") == F.col("__gone_row")), "left_anti")
            .drop("__file", "__row"))
