"""Per-drug marts (gold): adverse, sentiment, research, and the wide master table.

Scale notes
-----------
* ``adverse_profile`` scans and shuffles the fact table ONCE: a partial+final aggregation on
  (drug, reaction, age_group) produces a small cube, which is repartitioned by drug and turned
  into metrics, top reaction and age distribution by windows and one final aggregate (a linear
  plan, no joins). Partial aggregation runs map-side, so a drug holding a third of all reports
  is reduced before the shuffle instead of landing whole in one task.
* ``sentiment_profile`` rewrites ``count(distinct subreddit)`` as a two-level aggregation
  (drug, subreddit) -> drug, both levels with map-side partial aggregation, instead of the
  Expand-based distinct plan that replicates every input row.
* Everything downstream of the first aggregation is per-drug sized; AQE picks broadcast or
  sort-merge for the joins from runtime sizes (no unchecked ``broadcast`` hints).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pvspark.functions import rules
from pvspark.operators.dedup import dedup_latest


def _count_when(cond):
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def adverse_cube(reports: DataFrame) -> DataFrame:
    """(drug, reaction, age_group) pre-aggregate shared by every adverse roll-up."""
    return reports.groupBy("drug_name", "reaction", "age_group").agg(
        F.count(F.lit(1)).alias("n"),
        _count_when(F.col("is_serious")).alias("serious"),
        _count_when(F.col("hospitalization") == 1).alias("hosp"),
        _count_when(F.col("death") == 1).alias("death"),
        _count_when(F.col("disability") == 1).alias("disab"),
        F.sum("age").alias("age_sum"),
        F.count("age").alias("age_n"),
    )


def adverse_metrics(cube: DataFrame) -> DataFrame:
    """A2: report count, four conditional sums and the average age per drug."""
    return cube.groupBy("drug_name").agg(
        F.sum("n").alias("total_reports"),
        F.sum("serious").alias("serious_reports"),
        F.sum("hosp").alias("hospitalization_reports"),
        F.sum("death").alias("death_reports"),
        F.sum("disab").alias("disability_reports"),
        F.try_divide(F.sum("age_sum").cast("double"), F.sum("age_n")).alias("avg_age"),
    )


def reaction_counts(cube: DataFrame) -> DataFrame:
    """A4: rows per (drug, reaction) with a non-null reaction."""
    return (cube.filter(F.col("reaction").isNotNull())
            .groupBy("drug_name", "reaction").agg(F.sum("n").alias("n")))


def top_reactions(counts: DataFrame, k: int = 5) -> DataFrame:
    """Top-k reactions per drug by count desc, reaction asc (a total order), with the
    share of the drug's reaction rows. ``row_number <= k`` plans as a WindowGroupLimit."""
    w = Window.partitionBy("drug_name").orderBy(F.col("n").desc(), F.col("reaction").asc())
    tot = Window.partitionBy("drug_name")
    return (counts.withColumn("denom", F.sum("n").over(tot))
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .withColumn("frequency_pct", F.lit(100.0) * F.col("n") / F.col("denom"))
            .drop("denom"))


def top_reaction(counts: DataFrame) -> DataFrame:
    """Most common reaction per drug (ties -> alphabetically first)."""
    w = Window.partitionBy("drug_name").orderBy(F.col("n").desc(), F.col("reaction").asc())
    return (counts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("drug_name", F.col("reaction").alias("most_common_reaction"), "n"))


def age_distribution(cube: DataFrame, form: str = "object") -> DataFrame:
    """A5 (JSON object ``{"0-17":n,...}``) or A6 (JSON array of ``{age_group, ag_cnt}``),
    keys sorted. The list per drug is bounded by the number of age buckets."""
    ag = cube.groupBy("drug_name", "age_group").agg(F.sum("n").alias("ag_cnt"))
    pairs = F.sort_array(F.collect_list(F.struct("age_group", "ag_cnt")))
    if form == "object":
        val = F.to_json(F.map_from_entries(pairs))
    elif form == "array":
        val = F.to_json(pairs)
    else:
        raise ValueError(form)
    return ag.groupBy("drug_name").agg(val.alias("age_group_distribution"))


def adverse_profile(reports: DataFrame, dist: str = "object") -> DataFrame:
    """Metrics + top reaction + age distribution per drug, as ONE linear plan.

    The three mart branches (metrics, top reaction, age distribution) are evaluated from the
    same pre-aggregated cube instead of being joined: the cube (bounded by drugs x reactions x
    age groups, whatever the fact count) is hash-partitioned by drug once; reaction totals and
    age-group totals are window sums inside that partitioning (no further exchange); a final
    per-drug aggregate picks the top reaction with ``min_by`` over (-count, reaction) and builds
    the sorted age distribution from the (at most 5) distinct age-group pairs. Result equals
    metrics LEFT JOIN top_reaction LEFT JOIN age_distribution, since every drug has >= 1 row.
    """
    cube = adverse_cube(reports).repartition("drug_name")
    r_tot = F.sum("n").over(Window.partitionBy("drug_name", "reaction"))
    a_tot = F.sum("n").over(Window.partitionBy("drug_name", "age_group"))
    c = cube.withColumn("r_tot", r_tot).withColumn("a_tot", a_tot)
    pick = F.when(F.col("reaction").isNotNull(), F.struct((-F.col("r_tot")).alias("neg_n"), F.col("reaction").alias("r")))
    pairs = F.sort_array(F.collect_set(F.struct(F.col("age_group"), F.col("a_tot").alias("ag_cnt"))))
    val = F.to_json(F.map_from_entries(pairs)) if dist == "object" else F.to_json(pairs)
    if dist not in ("object", "array"):
        raise ValueError(dist)
    return c.groupBy("drug_name").agg(
        F.sum("n").alias("total_reports"),
        F.sum("serious").alias("serious_reports"),
        F.sum("hosp").alias("hospitalization_reports"),
        F.sum("death").alias("death_reports"),
        F.sum("disab").alias("disability_reports"),
        F.try_divide(F.sum("age_sum").cast("double"), F.sum("age_n")).alias("avg_age"),
        F.min_by(F.col("reaction"), pick).alias("most_common_reaction"),
        val.alias("age_group_distribution"))


def adverse_profile_joined(reports: DataFrame, dist: str = "object") -> DataFrame:
    """The same mart as three roll-ups of the cube joined on drug_name (the SQL model's shape)."""
    cube = adverse_cube(reports)
    m = adverse_metrics(cube)
    tr = top_reaction(reaction_counts(cube)).drop("n")
    ag = age_distribution(cube, dist)
    return m.join(tr, "drug_name", "left").join(ag, "drug_name", "left")


def explode_mentions(posts: DataFrame, key_mode: str = "normalized") -> DataFrame:
    """One row per (post, mentioned drug), trimmed; ``normalized`` also upper-cases so the
    keys meet the report keys (F1), ``exact`` keeps the reference's trim-only key."""
    name = F.trim(F.col("_m"))
    if key_mode == "normalized":
        name = F.upper(name)
    elif key_mode != "exact":
        raise ValueError(key_mode)
    return (posts.filter(F.col("drug_mentions").isNotNull())
            .select("*", F.explode(F.split("drug_mentions", ",")).alias("_m"))
            .withColumn("drug_name", name).drop("_m"))


def sentiment_profile(posts: DataFrame, key_mode: str = "normalized", distinct: str = "exact") -> DataFrame:
    """A3: mentions, avg score, distinct forums, avg body length per mentioned drug.
    Empty keys are dropped; the ``unknown`` key is kept (as the reference does).
    ``distinct="approx"`` (opt-in) counts forums with one HyperLogLog aggregation instead of the
    exact two-level plan."""
    ex = explode_mentions(posts, key_mode).filter(F.col("drug_name").isNotNull() & (F.col("drug_name") != ""))
    if distinct == "approx":
        return ex.groupBy("drug_name").agg(
            F.count(F.lit(1)).alias("total_mentions"), F.avg("score").alias("avg_score"),
            F.approx_count_distinct("subreddit").alias("subreddit_count"),
            F.avg("body_length").alias("avg_body_length"))
    if distinct != "exact":
        raise ValueError(distinct)
    lvl1 = ex.groupBy("drug_name", "subreddit").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("s_sum"), F.count("score").alias("s_n"),
        F.sum("body_length").alias("b_sum"), F.count("body_length").alias("b_n"))
    return lvl1.groupBy("drug_name").agg(
        F.sum("n").alias("total_mentions"),
        F.try_divide(F.sum("s_sum").cast("double"), F.sum("s_n")).alias("avg_score"),
        F.count("subreddit").alias("subreddit_count"),
        F.try_divide(F.sum("b_sum").cast("double"), F.sum("b_n")).alias("avg_body_length"))


SKETCH_LG_K = 12            # HyperLogLog registers: relative standard error of about 1.6 %


def sentiment_daily(posts: DataFrame, key_mode: str = "normalized") -> DataFrame:
    """A3 as mergeable states: per drug and day the sums of the mart's columns and a sketch of the forums. A day is computed once
    and kept; days are put together by ``sentiment_merge``."""
    ex = explode_mentions(posts, key_mode).filter(F.col("drug_name").isNotNull() & (F.col("drug_name") != ""))
    return ex.groupBy("drug_name", F.to_date("created_utc").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("s_sum"), F.count("score").alias("s_n"),
        F.sum("body_length").alias("b_sum"), F.count("body_length").alias("b_n"),
        F.hll_sketch_agg("subreddit", F.lit(SKETCH_LG_K)).alias("forums"))


def sentiment_merge(daily: DataFrame) -> DataFrame:
    """The sentiment mart of any set of days from their states: equal to one run over those days. Forums are the sketch's
    estimate (exact for few, about 1.6 % off for many)."""
    return daily.groupBy("drug_name").agg(
        F.sum("n").alias("total_mentions"),
        F.try_divide(F.sum("s_sum").cast("double"), F.sum("s_n")).alias("avg_score"),
        F.hll_sketch_estimate(F.hll_union_agg("forums")).alias("subreddit_count"),
        F.try_divide(F.sum("b_sum").cast("double"), F.sum("b_n")).alias("avg_body_length"))


def research_profile(articles: DataFrame) -> DataFrame:
    """A1: papers, average abstract length, latest / earliest year per drug."""
    return (articles.filter(F.col("drug_name").isNotNull()).groupBy("drug_name").agg(
        F.count(F.lit(1)).alias("total_papers"),
        F.avg("abstract_length").alias("avg_abstract_length"),
        F.max("publish_year").alias("latest_publish_year"),
        F.min("publish_year").alias("earliest_publish_year")))


def pick_labels(labels: DataFrame, label_pick: str = "one") -> DataFrame:
    """``one`` keeps one label per brand (latest ingestion_ts, then smallest drug_id);
    ``all`` keeps every label (the reference's fan-out)."""
    if label_pick == "all":
        return labels
    if label_pick != "one":
        raise ValueError(label_pick)
    order = (["ingestion_ts desc"] if "ingestion_ts" in labels.columns else []) + ["drug_id"]
    return dedup_latest(labels, "brand_name", order)


MASTER_ADV = ["total_reports", "serious_reports", "hospitalization_reports", "death_reports",
              "disability_reports", "avg_age", "most_common_reaction", "age_group_distribution"]
MASTER_SENT = ["avg_score", "subreddit_count", "avg_body_length"]
MASTER_RES = ["total_papers", "avg_abstract_length", "latest_publish_year", "earliest_publish_year"]
MASTER_LBL = ["drug_id", "brand_name", "generic_name", "warnings", "interactions", "has_interactions",
              "warnings_length", "ingestion_ts"]


def master_profile(adv: DataFrame, sent: DataFrame, res: DataFrame, labels: DataFrame,
                   label_pick: str = "one") -> DataFrame:
    """J2 + P21: adverse LEFT JOIN sentiment, research, labels (label key = brand_name), with the
    prefixed projection. All four inputs are per-drug sized; the joins are equi-joins."""
    a = adv.select("drug_name", *[F.col(c).alias(f"adv_{c}") for c in MASTER_ADV if c in adv.columns])
    s = sent.select("drug_name", F.col("total_mentions").alias("_tm"),
                    *[F.col(c).alias(f"sent_{c}") for c in MASTER_SENT])
    r = res.select("drug_name", *[F.col(c).alias(f"res_{c}") for c in MASTER_RES])
    lab = pick_labels(labels, label_pick)
    lcols = [c for c in MASTER_LBL if c in lab.columns]
    lb = lab.select(F.col("brand_name").alias("_brand"), *[F.col(c).alias(f"lbl_{c}") for c in lcols])
    out = (a.join(s, "drug_name", "left").join(r, "drug_name", "left")
           .join(lb, F.col("drug_name") == F.col("_brand"), "left"))
    return out.select(
        "drug_name", *[f"adv_{c}" for c in MASTER_ADV if c in adv.columns],
        F.coalesce(F.col("_tm"), F.lit(0)).alias("sent_total_mentions"),
        *[f"sent_{c}" for c in MASTER_SENT], *[f"res_{c}" for c in MASTER_RES],
        *[f"lbl_{c}" for c in lcols])


def build_master(reports: DataFrame, posts: DataFrame, articles: DataFrame, labels: DataFrame,
                 key_mode: str = "normalized", label_pick: str = "one") -> DataFrame:
    """Silver tables -> master. ``key_mode`` decides how mentioned drug names are keyed (F1)."""
    return master_profile(adverse_profile(reports), sentiment_profile(posts, key_mode),
                          research_profile(articles), labels, label_pick)


def invariant_serious(adv: DataFrame) -> DataFrame:
    """Q10: rows violating serious_reports <= total_reports (must be empty)."""
    return adv.filter(F.col("serious_reports") > F.col("total_reports"))


def outcome_rates(adv: DataFrame) -> DataFrame:
    """A10: outcome rates per drug over drugs with at least one report."""
    t = F.col("total_reports").cast("double")
    return adv.filter(F.col("total_reports") > 0).select(
        "drug_name",
        F.try_divide(F.col("serious_reports"), t).alias("serious_rate"),
        F.try_divide(F.col("hospitalization_reports"), t).alias("hospitalization_rate"),
        F.try_divide(F.col("death_reports"), t).alias("death_rate"),
        F.try_divide(F.col("disability_reports"), t).alias("disability_rate"))
