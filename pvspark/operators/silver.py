"""Clean ("silver") tables: typed, filtered, key-normalised, enriched, deduplicated.

Each function is a pure DataFrame -> DataFrame transform. Filters are written against raw
columns before derived expressions, so simple predicates reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pvspark.functions import dates, rules
from pvspark.operators.dedup import dedup_latest

REPORT_COLUMNS = ["report_id", "drug_name", "reaction", "severity", "age", "weight", "report_date",
                  "age_group", "is_serious", "hospitalization", "death", "disability"]


def _non_blank(c: str):
    return F.col(c).isNotNull() & (F.length(F.trim(F.col(c))) > 0)


def clean_reports(raw: DataFrame, order: Sequence[str] | None = None, dedup_method: str = "window") -> DataFrame:
    """P1-P3, P7-P10, W2 on flat report records."""
    df = (raw.filter(_non_blank("drug_name"))
          .withColumn("age", rules.lenient_int("age"))
          .withColumn("weight", F.col("weight").try_cast("double"))
          .withColumn("report_date", dates.report_date("report_date"))
          .withColumn("drug_name", rules.norm_key("drug_name"))
          .withColumn("age_group", rules.age_group("age"))
          .withColumn("severity", rules.lenient_int("severity"))
          .withColumn("is_serious", F.col("severity") == F.lit(1))
          .withColumn("hospitalization", rules.zero_if_null_int("hospitalization"))
          .withColumn("death", rules.zero_if_null_int("death"))
          .withColumn("disability", rules.zero_if_null_int("disability")))
    return dedup_latest(df, "report_id", order, method=dedup_method)


def clean_articles(raw: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """P1, P5, P7, P11, P12, W2 on article records."""
    df = (raw.filter(F.col("abstract").isNotNull() & (F.length("abstract") >= 10))
          .withColumn("publish_date", F.col("publish_date").try_cast("date"))
          .withColumn("drug_name", rules.norm_key("drug_name"))
          .withColumn("abstract_length", F.length("abstract"))
          .withColumn("publish_year", F.year("publish_date")))
    return dedup_latest(df, "article_id", order)


def clean_posts(raw: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """P1, P6, P11-P13, W2 on forum posts. ``drug_list`` is the untrimmed CSV split."""
    created = F.col("created_utc")
    df = raw.filter(F.col("body").isNotNull() & (F.length("body") > 0))
    if dict(df.dtypes)["created_utc"] == "string":
        df = df.withColumn("created_utc", created.try_cast("timestamp"))
    df = (df.withColumn("body_length", F.length("body"))
          .withColumn("hour_of_day", F.hour("created_utc"))
          .withColumn("drug_list", F.split(F.col("drug_mentions"), ",")))
    return dedup_latest(df, "post_id", order)


def clean_labels(raw: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """P4, P7, P11, P14, W2 on drug labels.

    The sentinel filter keeps SQL three-valued logic: (null, 'unknown') evaluates to NULL and is
    dropped, (null, 'X') is kept.
    """
    sentinel = (F.col("brand_name") == F.lit("unknown")) & (F.col("generic_name") == F.lit("unknown"))
    df = (raw.filter(~sentinel)
          .withColumn("brand_name", rules.norm_key("brand_name"))
          .withColumn("generic_name", rules.norm_key("generic_name"))
          .withColumn("has_interactions", F.col("interactions").isNotNull() & (F.length("interactions") > 10))
          .withColumn("warnings_length", F.length("warnings")))
    return dedup_latest(df, "drug_id", order)
