"""Comparison forms used only by ``bench.py`` (same results as registered queries, other plans)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pvspark.plans.base import round_doubles
from pvspark.plans.layers import ADV_COLS, REPORT_COLS, silver_reports_df


def adverse_naive(spark, sf_dir):
    """The mart as three independent branches over the facts (the CTE-per-branch form):
    three aggregations of the fact table instead of one shared pre-aggregate."""
    from pyspark.sql import Window
    s = silver_reports_df(spark, sf_dir)
    m = s.groupBy("drug_name").agg(
        F.count(F.lit(1)).alias("total_reports"),
        F.sum(F.when(F.col("is_serious"), 1).otherwise(0)).alias("serious_reports"),
        F.sum(F.when(F.col("hospitalization") == 1, 1).otherwise(0)).alias("hospitalization_reports"),
        F.sum(F.when(F.col("death") == 1, 1).otherwise(0)).alias("death_reports"),
        F.sum(F.when(F.col("disability") == 1, 1).otherwise(0)).alias("disability_reports"),
        F.avg("age").alias("avg_age"))
    rc = s.filter(F.col("reaction").isNotNull()).groupBy("drug_name", "reaction").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("drug_name").orderBy(F.col("n").desc(), F.col("reaction"))
    tr = rc.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(
        "drug_name", F.col("reaction").alias("most_common_reaction"))
    ag = s.groupBy("drug_name", "age_group").agg(F.count(F.lit(1)).alias("ag_cnt")).groupBy("drug_name").agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("age_group", "ag_cnt"))))).alias(
            "age_group_distribution"))
    return round_doubles(m.join(tr, "drug_name", "left").join(ag, "drug_name", "left").select(*ADV_COLS))


def silver_min_by(spark, sf_dir):
    return round_doubles(silver_reports_df(spark, sf_dir, method="min_by").select(*REPORT_COLS))


EXTRA = {"mart_adverse_naive": adverse_naive, "silver_reports_min_by": silver_min_by}
