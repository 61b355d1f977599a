"""Structured Streaming ingest of forum messages (S8, K2, ST1-ST6, K11).

Source: a Kafka topic in production (``format("kafka")``, value bytes) or a folder of JSON-lines
files (tests; same downstream plan). Each message is decoded JVM-side (``try_parse_json`` ->
VARIANT), validated with the consumer's rules, enriched with the keyword tagger, and written by
``foreachBatch`` as ONE partitioned write per micro-batch (``is_valid=true`` rows and the
``is_valid=false`` quarantine with its reason) to ``query=<id>/batch=<id>`` folders. The query id is
the checkpoint's, so a replayed batch overwrites its own output (the sink is idempotent under
at-least-once replay) and a new checkpoint never overwrites an older query's batches.

Dedup (ST2/U2) is ``dropDuplicatesWithinWatermark(["post_id"])``: state is bounded by the
watermark delay, unlike the reference's ever-growing in-memory id set. Duplicates farther apart
than the delay pass again by design; the batch dedup of the silver layer removes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pvspark.functions.text import DRUG_KEYWORDS, tag_all, tag_dictionary
from pvspark.operators.validate import post_rules, reason

DECODE_ERROR = "could not decode message"

NOT_A_TIME = "created_utc is not a timestamp"

# --- fixed values: micro-batch timing of the consumer ---------------------------------------
# An idle consumer flushes after 10 seconds; a full one at once. A batch here holds whatever has
# arrived, so there is no limit of messages unless the caller gives one.
TRIGGER = {"processingTime": "10 seconds"}
# ------------------------------------------------------------------------------------------

MESSAGE_FIELDS = [("post_id", "string"), ("subreddit", "string"), ("title", "string"), ("body", "string"),
                  ("score", "int"), ("created_utc", "string"), ("drug_mentions", "string")]


def read_messages(spark: SparkSession, source: str = "files", path: str | None = None,
                  options: dict | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """A stream of raw messages with one column ``value``.

    ``files``: JSON-lines text files under ``path`` (``maxFilesPerTrigger`` = max_per_trigger).
    ``kafka``: the topic named in ``options`` (``subscribe``, ``kafka.bootstrap.servers`` ...),
    earliest offsets, ``maxOffsetsPerTrigger`` = max_per_trigger; needs the Kafka connector jar.
    """
    opts = dict(options or {})
    if source == "files":
        r = spark.readStream.format("text")
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_per_trigger))
        return r.load(path)
    if source == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        r = spark.readStream.format("kafka").options(**opts)
        return r.load().select(F.col("value"))
    raise ValueError(source)


def decode_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """ST1: message -> typed post record + ``reject_reason`` (NULL when valid).

    Bytes that are not UTF-8, text that is not JSON, and JSON that is not an object (a list, a
    scalar) are rejected as undecodable - the reference would crash on the last two.
    """
    raw = F.col(value_col)
    if dict(df.dtypes)[value_col] == "binary":
        text = F.when(F.is_valid_utf8(raw), F.decode(raw, "UTF-8"))
    else:
        text = raw.cast("string")
    v = F.try_parse_json(text)
    # text that parses is an object if its first character is a brace
    is_obj = F.coalesce(v.isNotNull() & text.rlike(r"^[ \t\r\n]*\{"), F.lit(False))
    typed = df.select(text.alias("raw"), v.alias("_v"), is_obj.alias("_obj"))
    typed = typed.select("raw", "_obj", *[F.try_variant_get("_v", f"$.{n}", t).alias(n) for n, t in MESSAGE_FIELDS])
    # presence is tested on the text of the message; text that is no time has a reason of its own
    when = F.col("created_utc").try_cast("timestamp")
    why = F.when(~F.col("_obj"), F.lit(DECODE_ERROR)).otherwise(reason([*post_rules(), (NOT_A_TIME, when.isNull())]))
    return typed.withColumn("reject_reason", why).drop("_obj").withColumn("created_utc", when)


def enrich(df: DataFrame, terms=DRUG_KEYWORDS) -> DataFrame:
    """ST6: fill missing ``drug_mentions`` with the all-matches tagger (same function as batch)."""
    hay = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    return df.withColumn("drug_mentions", F.coalesce(F.col("drug_mentions"), tag_all(hay, terms)))


def enrich_batch(batch: DataFrame, dictionary: DataFrame, col: str = "term") -> DataFrame:
    """ST6 with a dictionary table of any size, for a micro-batch: fill missing ``drug_mentions``."""
    hay = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    return (tag_dictionary(batch, hay, dictionary, col, "__found")
            .withColumn("drug_mentions", F.coalesce("drug_mentions", "__found")).drop("__found"))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint (its metadata file, written before the first batch)."""
    row = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()
    return row["id"]


def write_batches(decoded: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                  query_name: str | None = None, quality_out: str | None = None, dictionary: DataFrame | None = None) -> StreamingQuery:
    """K2 + K11 + ST4: valid rows and quarantine, one partitioned overwrite per query and batch id.

    ``dictionary`` (column ``term``): fill missing ``drug_mentions`` of each batch from this table (ST6).

    With ``quality_out`` the posts suite (Q7) also runs on each batch's valid rows and its
    per-check results are written below ``quality_out`` likewise (recorded, not a gate: a stream
    keeps running). The micro-batch is persisted for the two passes and released afterwards."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        part = f"query={_query_id(batch.sparkSession, checkpoint)}/batch={batch_id}"
        tagged = batch if dictionary is None else enrich_batch(batch, dictionary)
        tagged = tagged.withColumn("is_valid", F.col("reject_reason").isNull())
        if quality_out:
            tagged = tagged.persist()
        tagged.write.mode("overwrite").partitionBy("is_valid").parquet(f"{out}/{part}")
        if quality_out:
            from pvspark.operators.quality import run_named_suite
            valid = tagged.filter("is_valid").drop("is_valid", "reject_reason", "raw")
            run_named_suite(valid, "posts").write.mode("overwrite").parquet(f"{quality_out}/{part}")
            tagged.unpersist()

    w = decoded.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_ingest(spark: SparkSession, out: str, checkpoint: str, source: str = "kafka", path: str | None = None,
                 options: dict | None = None, trigger: dict | None = None,
                 max_per_trigger: int | None = None, quality_out: str | None = None,
                 terms=DRUG_KEYWORDS) -> StreamingQuery:
    """S8 + ST1-ST6 wired together with the consumer's 10-second batches;
    ``max_per_trigger`` limits a batch only if given (files or offsets); pass ``trigger={"availableNow": True}`` to drain what is there and stop."""
    stream = enrich(decode_messages(read_messages(spark, source, path, options, max_per_trigger)), terms)
    return write_batches(stream, out, checkpoint, trigger or TRIGGER, quality_out=quality_out)


def dedup_stream(decoded: DataFrame, delay: str = "1 hour") -> DataFrame:
    """ST2 / U2: valid records, first arrival of each post_id within the watermark delay."""
    return (decoded.filter(F.col("reject_reason").isNull())
            .withWatermark("created_utc", delay)
            .dropDuplicatesWithinWatermark(["post_id"]))


def write_append(df: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                 fmt: str = "parquet") -> StreamingQuery:
    """File sink, append mode, exactly-once through the checkpoint's commit log."""
    return (df.writeStream.format(fmt).outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    df = spark.read.option("basePath", out).parquet(f"{out}/query=*/batch=*")
    return df.withColumn("is_valid", F.col("is_valid").cast("boolean"))


def message_json(posts: DataFrame, seq: Column) -> Column:
    """Posts -> message text. ``seq`` picks rows to corrupt: every 101st is not JSON, every
    103rd a JSON list (both undecodable), every 47th has a time that is none."""
    body = F.to_json(F.struct(
        F.col("post_id"), F.col("subreddit"), F.col("title"), F.col("body"), F.col("score"),
        F.when(seq % 47 == 0, F.lit("yesterday")).otherwise(
            F.date_format("created_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("created_utc"),
        F.col("drug_mentions")))
    return (F.when(seq % 101 == 0, F.concat(F.lit("not json {"), seq.cast("string")))
            .when(seq % 103 == 0, F.concat(F.lit("["), seq.cast("string"), F.lit("]")))
            .otherwise(body))
