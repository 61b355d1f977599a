"""Post search / union operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pvspark.functions.text import SAFETY_TERMS, SUBREDDITS, contains_any
from pvspark.operators.dedup import dedup_latest, order_columns


def filter_safety_terms(df: DataFrame, forums: Sequence[str] = SUBREDDITS,
                        terms: Sequence[str] = SAFETY_TERMS) -> DataFrame:
    """Keep posts of the searched forums whose title or body contains any phrase.
    ``subreddit IN (...)`` is a plain predicate, so it is pushed to a parquet scan."""
    hay = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    return df.filter(F.col("subreddit").isin(list(forums))).filter(contains_any(hay, terms))


def union_posts(posts: DataFrame, comments: DataFrame, order: Sequence[str] = ("created_utc",)) -> DataFrame:
    """Posts and comments as one stream of records; rows without an id are skipped and
    the first-seen record of each id wins (``order`` = arrival order)."""
    both = posts.unionByName(comments, allowMissingColumns=True)
    both = both.filter(F.col("post_id").isNotNull() & (F.col("post_id") != ""))
    return dedup_latest(both, "post_id", list(order))


def latest_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Most recent ``n`` rows under a total order -> TakeOrderedAndProject (each task
    keeps its own top n; only n rows per task reach the final merge)."""
    return df.orderBy(*order_columns(order)).limit(n)


def newest_labels(payloads: DataFrame, n: int = 100) -> DataFrame:
    """S7 on label payloads (VARIANT column ``v``): the ``n`` newest by ``effective_time``, ties by id, those without a day last.
    Only those are validated and extracted afterwards."""
    keyed = payloads.select("v", F.try_variant_get("v", "$.effective_time", "string").alias("day"),
                            F.try_variant_get("v", "$.id", "string").alias("id"))
    return latest_n(keyed, n, ["day desc", "id"]).select("v")
