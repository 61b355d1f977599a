"""The risk report for a whole TABLE of requests in one pass.

The reference answers one request at a time (reloading models and rescanning whole frames per
request). Here every per-drug KPI is a grouped aggregate computed once, models score all request
rows in one ``transform`` each, and the KPIs join the request rows on the drug key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.functions import rules
from pvspark.functions.text import DEPENDENCY_TERMS, NEGATIVE_RESEARCH_TERMS, WITHDRAWAL_TERMS
from pvspark.operators import kpi, marts
from pvspark.operators.model import CATEGORICAL, CONTINUOUS, path_contributions, positive_probability, scoring_rows

_ML_COLS = ["drug_name_idx", "age_group_idx", "drug_name_ohe", "age_group_ohe", "features", "rawPrediction", "probability", "prediction", "p1"]


def predict_all(rows: DataFrame, models: dict) -> DataFrame:
    """M6: one probability column per model (x100), scored by chained transforms (no joins)."""
    out = rows
    for name, m in models.items():
        out = positive_probability(m.transform(out)).withColumn(f"{name}_pct", F.col("p1") * 100.0)
        out = out.drop(*[c for c in _ML_COLS if c in out.columns])
    return out


def top5_lists(reports: DataFrame) -> DataFrame:
    """W3 / T3 as a per-drug list<struct<reaction, frequency_pct>> (bounded by 5)."""
    t = marts.top_reactions(marts.reaction_counts(marts.adverse_cube(reports)), 5)
    return t.groupBy("drug_name").agg(F.sort_array(F.collect_list(F.struct(
        "rank", "reaction", "frequency_pct"))).alias("_l")).select(
        "drug_name", F.transform("_l", lambda s: F.struct(s["reaction"].alias("reaction"),
                                                          s["frequency_pct"].alias("frequency_pct"))).alias("top_5_reactions"))


def risk_report(requests: DataFrame, master: DataFrame, posts: DataFrame, articles: DataFrame,
                labels: DataFrame, reports: DataFrame, models: dict, key_mode: str = "normalized", dependency_terms=DEPENDENCY_TERMS,
                withdrawal_terms=WITHDRAWAL_TERMS, research_terms=NEGATIVE_RESEARCH_TERMS
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Requests (request_id, drug_name, age, weight) -> (report rows, not-found requests,
    rejected requests). Report columns are the 16 response fields plus the request columns."""
    valid, rejected = kpi.validate_requests(requests)
    found, missing = kpi.lookup(valid, master.select("drug_name"), key_mode)
    rows = scoring_rows(found, master).withColumn("drug_name", F.col("lookup_key"))
    scored = predict_all(rows, models)

    contrib = path_contributions(models["serious"], rows.select("request_id", *CATEGORICAL, *CONTINUOUS), key="request_id")
    shap = contrib.groupBy("request_id").agg(F.sort_array(F.collect_list(F.struct(
        "rank", "feature", "contribution"))).alias("_c")).select(
        "request_id",
        F.transform("_c", lambda s: F.struct(s["feature"].alias("feature"),
                                             s["contribution"].alias("contribution"))).alias("shap_values"),
        F.get(F.col("_c"), 0)["feature"].alias("top_risk_factor"))

    mr = kpi.mention_rates(posts, dependency_terms, withdrawal_terms).select(
        "drug_name", F.col("dependency_rate").alias("dependency_mention_rate"),
        F.col("withdrawal_rate").alias("withdrawal_mention_rate"))
    cs = kpi.concern_score(posts).select("drug_name", F.col("concern").alias("community_concern_score"))
    rc = kpi.research_consensus(articles, research_terms).select(
        "drug_name", F.col("consensus").alias("research_risk_consensus"), F.col("total").alias("total_research_papers"))
    lo = kpi.label_override(master, labels).select(
        "drug_name", F.col("severity").alias("label_warning_severity"), "known_interactions")
    t5 = top5_lists(reports)

    rep = scored
    for kp in (mr, cs, rc, lo, t5):
        rep = rep.join(kp, "drug_name", "left")
    rep = rep.join(shap, "request_id", "left")
    z = F.lit(0.0)
    out = rep.select(
        "request_id", "drug_name", "age", "weight",
        F.col("serious_pct").alias("serious_reaction_pct"), "hospitalization_pct", "death_pct", "disability_pct",
        rules.risk_label(F.col("serious_pct")).alias("risk_label"),
        "shap_values", "top_risk_factor",
        F.coalesce("dependency_mention_rate", z).alias("dependency_mention_rate"),
        F.coalesce("withdrawal_mention_rate", z).alias("withdrawal_mention_rate"),
        F.coalesce("community_concern_score", z).alias("community_concern_score"),
        F.coalesce("research_risk_consensus", z).alias("research_risk_consensus"),
        F.coalesce("total_research_papers", F.lit(0)).alias("total_research_papers"),
        F.coalesce("top_5_reactions", F.array().cast("array<struct<reaction:string,frequency_pct:double>>"))
        .alias("top_5_reactions"),
        F.coalesce("label_warning_severity", F.lit("LOW")).alias("label_warning_severity"),
        F.coalesce("known_interactions", F.array().cast("array<string>")).alias("known_interactions"))
    return out, missing, rejected


def _num1(c: Column) -> Column:
    return rules.pct1(c)


def summary_text(report: DataFrame) -> DataFrame:
    """The 12-line risk summary per report row."""
    lines = [
        F.concat(F.lit("Serious reaction: "), _num1(F.col("serious_reaction_pct")), F.lit("%")),
        F.concat(F.lit("Hospitalization: "), _num1(F.col("hospitalization_pct")), F.lit("%")),
        F.concat(F.lit("Death: "), _num1(F.col("death_pct")), F.lit("%")),
        F.concat(F.lit("Disability: "), _num1(F.col("disability_pct")), F.lit("%")),
        F.concat(F.lit("Risk label: "), F.coalesce("risk_label", F.lit("UNKNOWN"))),
        F.concat(F.lit("Top risk factor: "), F.coalesce("top_risk_factor", F.lit("n/a"))),
        F.concat(F.lit("Dependency mention rate: "), _num1(F.col("dependency_mention_rate")), F.lit("%")),
        F.concat(F.lit("Withdrawal mention rate: "), _num1(F.col("withdrawal_mention_rate")), F.lit("%")),
        F.concat(F.lit("Community concern score: "), _num1(F.col("community_concern_score"))),
        F.concat(F.lit("Research risk consensus: "), _num1(F.col("research_risk_consensus")), F.lit("%")),
        F.concat(F.lit("Total research papers: "), F.col("total_research_papers").cast("long").cast("string")),
        F.concat(F.lit("Label warning severity: "), F.coalesce("label_warning_severity", F.lit("UNKNOWN"))),
    ]
    return report.select("request_id", "drug_name", F.concat_ws("\n", *lines).alias("text"))


# Fixed value: the status of a request whose drug is missing.
NOT_FOUND = "Drug not found or API unavailable"


def display_rows(report: DataFrame, missing: DataFrame) -> DataFrame:
    """The display table - formatted numbers for reported requests, an all-``N/A`` row
    (status "not found", risk UNKNOWN) for requests whose drug is missing."""
    na = F.lit("N/A")
    rx = F.transform("top_5_reactions", lambda r: F.concat_ws(": ", r["reaction"], rules.pct1(r["frequency_pct"])))
    found = report.select(
        "request_id", "drug_name", F.col("age").cast("string").alias("age"), rules.age_group(F.col("age")).alias("age_group"),
        F.concat(rules.pct1(F.col("serious_reaction_pct")), F.lit("%")).alias("serious"),
        F.concat(rules.pct1(F.col("hospitalization_pct")), F.lit("%")).alias("hospitalization"),
        F.concat(rules.pct1(F.col("death_pct")), F.lit("%")).alias("death"),
        F.concat(rules.pct1(F.col("disability_pct")), F.lit("%")).alias("disability"),
        F.coalesce("risk_label", F.lit("UNKNOWN")).alias("risk_label"),
        F.coalesce(F.nullif(F.col("top_risk_factor"), F.lit("")), na).alias("top_risk_factor"),
        F.col("total_research_papers").cast("long").cast("string").alias("total_papers"),
        rules.pct1(F.col("community_concern_score")).alias("community_concern"),
        F.concat(rules.pct1(F.col("research_risk_consensus")), F.lit("%")).alias("research_consensus"),
        F.concat(rules.pct1(F.col("dependency_mention_rate")), F.lit("%")).alias("dependency_rate"),
        F.concat(rules.pct1(F.col("withdrawal_mention_rate")), F.lit("%")).alias("withdrawal_rate"),
        F.when(F.size("top_5_reactions") > 0, F.array_join(rx, "\n")).otherwise(na).alias("reactions"),
        F.when(F.size("known_interactions") > 0, F.array_join("known_interactions", "\n"))
        .otherwise(F.lit("None reported")).alias("interactions"),
        F.coalesce("label_warning_severity", F.lit("LOW")).alias("warning_severity"),
        F.lit("ok").alias("status"))
    absent = missing.select(
        "request_id", "drug_name", F.col("age").cast("string").alias("age"), rules.age_group(F.col("age")).alias("age_group"),
        *[na.alias(c) for c in ("serious", "hospitalization", "death", "disability")],
        F.lit("UNKNOWN").alias("risk_label"), na.alias("top_risk_factor"), na.alias("total_papers"),
        na.alias("community_concern"), na.alias("research_consensus"), na.alias("dependency_rate"),
        na.alias("withdrawal_rate"), na.alias("reactions"), na.alias("interactions"), na.alias("warning_severity"),
        F.lit(NOT_FOUND).alias("status"))
    return found.unionByName(absent)
