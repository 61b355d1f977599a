"""Build step 8: streaming queries, each drained with ``availableNow`` and compared with the batch
form of the same rules. The message files are derived from the driver tables (posts_raw) and
written under the shared checkpoint folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pvspark.operators.sinks import stage
from pvspark.plans.base import register
from pvspark.session import scratch_path
from pvspark.sources import fixtures
from pvspark.streaming import batches, ingest

DEDUP_DELAY = "1 day"
REPLAY_DAYS = 60            # the replayed messages come this much later
SETTLED_DAYS = 7            # and are those whose post ended this long before the last message


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """posts_raw with every 43rd id null, every 47th time unreadable text; every third message comes without
    drug_mentions, which enrichment has to fill."""
    posts = fixtures.posts_raw(spark, sf_dir)
    seq = F.col("tie1")
    return (posts.withColumn("post_id", F.when(seq % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("post_id")))
            .withColumn("drug_mentions", F.when(seq % 3 != 0, F.col("drug_mentions"))))


def write_messages(spark: SparkSession, msgs: DataFrame) -> str:
    """JSON-lines message files, as many as the data has partitions; some lines are undecodable."""
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    msgs.select(ingest.message_json(msgs, F.col("tie1")).alias("value")).write.text(f"{root}/in")
    return root


def run_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_messages(spark, messages(spark, sf_dir))
    stream = ingest.decode_messages(ingest.read_messages(spark, "files", f"{root}/in"))
    q = ingest.write_batches(stream, f"{root}/out", f"{root}/ckpt", dictionary=fixtures.drug_dictionary(spark, sf_dir))
    q.awaitTermination()
    return ingest.read_batches(spark, f"{root}/out")


_VALID_SQL = fixtures.oracle_ctes("posts_raw") + """
, m AS (SELECT CASE WHEN tie1 % 43 = 0 THEN NULL ELSE post_id END AS post_id, subreddit, body, score,
               created_utc, drug_mentions, tie1, tie1 % 47 = 0 AS bad_time FROM posts_raw),
t AS (SELECT *, CASE WHEN tie1 % 101 = 0 OR tie1 % 103 = 0 THEN 'could not decode message'
                     WHEN post_id IS NULL OR post_id = '' THEN 'post_id is null'
                     WHEN body IS NULL OR body = '' THEN 'body is null or empty'
                     WHEN created_utc IS NULL THEN 'created_utc is null'
                     WHEN bad_time THEN 'created_utc is not a timestamp' END AS reject_reason FROM m)
"""


@register("stream_valid", _VALID_SQL + """
SELECT post_id, subreddit, body, score, drug_mentions FROM t WHERE reject_reason IS NULL""")
def q_stream_valid(spark, sf_dir):
    """S8 + ST1 + ST3 + ST6 + K2: valid messages written by the micro-batch sink."""
    out = run_ingest(spark, sf_dir)
    return out.filter("is_valid").select("post_id", "subreddit", "body", "score", "drug_mentions")


@register("stream_quarantine", _VALID_SQL + """
SELECT reject_reason AS reason, count(*) AS n FROM t WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
def q_stream_quarantine(spark, sf_dir):
    """ST1 + K11: rejected messages, each once with its reason (counted per reason)."""
    out = run_ingest(spark, sf_dir)
    return out.filter("not is_valid").groupBy(F.col("reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@register("stream_dedup", _VALID_SQL + f"""
, v AS (SELECT post_id, CAST(created_utc AS TIMESTAMP) AS seen FROM t WHERE reject_reason IS NULL),
p AS (SELECT post_id, max(seen) < (SELECT max(seen) FROM v) - INTERVAL {SETTLED_DAYS} DAY AS settled FROM v GROUP BY post_id)
SELECT post_id, CASE WHEN settled THEN 2 ELSE 1 END::BIGINT AS passes FROM p""")
def q_stream_dedup(spark, sf_dir):
    """ST2 / ST5 / U2: streaming dedup by post_id within a one-day watermark. After the first drain the stream is
    stopped; messages of settled posts are replayed much later and the stream restarts from its checkpoint: their
    state has been evicted, so each passes once more, and only once."""
    msgs = messages(spark, sf_dir)
    root = write_messages(spark, msgs)

    def drain():
        stream = ingest.decode_messages(ingest.read_messages(spark, "files", f"{root}/in"))
        ingest.write_append(ingest.dedup_stream(stream, DEDUP_DELAY).select("post_id", "created_utc"),
                            f"{root}/dedup", f"{root}/ckpt_dedup").awaitTermination()

    drain()
    valid = stage(ingest.decode_messages(spark.read.text(f"{root}/in")).filter("reject_reason is null")
                  .select("post_id", "subreddit", "title", "body", "score", "created_utc", "drug_mentions"), f"{root}/valid")
    last = valid.agg(F.max("created_utc")).scalar()
    settled = (valid.groupBy("post_id").agg(F.max("created_utc").alias("latest"))
               .filter(F.col("latest") < last - F.expr(f"INTERVAL {SETTLED_DAYS} DAY")).select("post_id"))
    again = (valid.join(settled, "post_id", "left_semi").withColumn("tie1", F.lit(1))
             .withColumn("created_utc", F.col("created_utc") + F.expr(f"INTERVAL {REPLAY_DAYS} DAY")))
    again.select(ingest.message_json(again, F.col("tie1")).alias("value")).write.mode("append").text(f"{root}/in")
    drain()
    return spark.read.parquet(f"{root}/dedup").groupBy("post_id").agg(F.count(F.lit(1)).alias("passes"))


LANES = 4


@register("stream_batches", fixtures.oracle_ctes("posts_base") + f"""
, m AS (SELECT CASE WHEN tie1 % 43 = 0 OR tie1 % 101 = 0 OR tie1 % 103 = 0 THEN 0 ELSE CAST(post_id AS BIGINT) % {LANES} END AS lane FROM posts_base)
SELECT CAST(lane AS VARCHAR) AS lane, count(*) AS messages, count(*) // {batches.SIZE} AS full_batches,
       CAST(count(*) % {batches.SIZE} > 0 AS BIGINT) AS idle_batches, max({batches.SIZE})::BIGINT AS largest, 0::BIGINT AS lost
FROM m GROUP BY lane""")
def q_stream_batches(spark, sf_dir):
    """ST3 + ST5: batches that close at 100 messages or when a lane is idle. Half of the messages come first, and the query is
    stopped with messages waiting; the rest comes after the restart, and the idle timers flush what is left."""
    msgs = messages(spark, sf_dir)
    text = msgs.select("tie1", ingest.message_json(msgs, F.col("tie1")).alias("value"))
    root = scratch_path(spark, f"batches-{uuid.uuid4().hex}")
    lane = F.coalesce(F.try_variant_get(F.try_parse_json("value"), "$.post_id", "bigint") % LANES, F.lit(0).cast("bigint"))
    text.filter("tie1 % 2 = 0").select("value").write.text(f"{root}/in")
    stream = ingest.read_messages(spark, "files", f"{root}/in")
    batches.run_until_quiet(stream, lane, f"{root}/out", f"{root}/ckpt", idle_seconds=3600, quiet=2)
    text.filter("tie1 % 2 = 1").select("value").write.mode("append").text(f"{root}/in")
    batches.run_until_quiet(stream, lane, f"{root}/out", f"{root}/ckpt", idle_seconds=2)
    out = spark.read.schema(batches.BATCH).parquet(f"{root}/out")
    lost = spark.read.text(f"{root}/in").exceptAll(out.select(F.explode("values").alias("value"))).agg(F.count(F.lit(1))).scalar()
    size = F.size("values").cast("bigint")
    return (out.groupBy("lane").agg(F.sum(size).alias("messages"), F.count_if(F.col("closed_by") == "size").alias("full_batches"),
                                    F.count_if(F.col("closed_by") == "idle").alias("idle_batches"), F.max(size).alias("largest"))
            .withColumn("lost", lost))
