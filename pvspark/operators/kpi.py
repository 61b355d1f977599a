"""Per-drug KPIs for the risk report (A7-A10, J4-J7, W3, P22-P24), as table-wide DataFrames.

The reference computes these for one requested drug at a time by rescanning in-memory frames;
here each KPI is computed once for every drug with grouped aggregations, and requests join the
result (``operators.score``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.functions import rules
from pvspark.functions.text import (DEPENDENCY_TERMS, NEGATIVE_RESEARCH_TERMS, WITHDRAWAL_TERMS,
                                    contains_any)
from pvspark.operators.dedup import dedup_latest


def post_mentions(posts: DataFrame, match: str = "key", drugs: DataFrame | None = None) -> DataFrame:
    """One row per (post, mentioned drug) - each post counts once per drug.

    ``match="key"``: explode the CSV and key by ``upper(trim(name))``, an equi-join key (differs
    from the reference's substring test only when one drug name contains another).
    ``match="substring"``: the reference's rule - a post mentions every drug (from ``drugs``,
    column ``drug_name``) whose name occurs case-insensitively anywhere in its CSV, by the n-gram
    join of ``functions.text.match_dictionary`` (a dictionary of any size, no cross join).
    """
    from pvspark.functions.text import match_dictionary

    if match == "key":
        names = F.array_distinct(F.filter(F.transform(F.split(F.col("drug_mentions"), ","), rules.norm_key),
                                          lambda x: x != F.lit("")))
        return (posts.filter(F.col("drug_mentions").isNotNull())
                .select("*", F.explode(names).alias("drug_name_key")))
    if match == "substring":
        if drugs is None:
            raise ValueError("substring matching needs the drug dictionary")
        p = match_dictionary(posts.filter(F.col("drug_mentions").isNotNull()), F.col("drug_mentions"), drugs, "drug_name", "_terms")
        return p.select("*", F.explode("_terms").alias("drug_name_key")).drop("_terms")
    raise ValueError(match)


def mention_rates(posts: DataFrame, dependency_terms: Sequence[str] = DEPENDENCY_TERMS,
                  withdrawal_terms: Sequence[str] = WITHDRAWAL_TERMS, match: str = "key",
                  drugs: DataFrame | None = None) -> DataFrame:
    """% of a drug's mentioning posts whose body contains any dependency / withdrawal term."""
    m = post_mentions(posts, match, drugs)
    dep = F.when(contains_any("body", dependency_terms), 1).otherwise(0)
    wd = F.when(contains_any("body", withdrawal_terms), 1).otherwise(0)
    return m.groupBy(F.col("drug_name_key").alias("drug_name")).agg(
        F.count(F.lit(1)).alias("total"),
        (F.lit(100.0) * F.avg(dep)).alias("dependency_rate"),
        (F.lit(100.0) * F.avg(wd)).alias("withdrawal_rate"))


def concern_score(posts: DataFrame) -> DataFrame:
    """A drug's average post score, min-max scaled by the GLOBAL score range over ALL posts,
    clamped to 0-100; 50 when the range is empty (max = min); 0 when the drug has no score.

    One pass over the posts: ``explode_outer`` keeps posts without mentions (NULL key), so the
    per-key aggregate carries every post's score; the global range is the min / max over that
    small per-key table (a scalar subquery whose plan reuses the same exchange)."""
    names = F.array_distinct(F.filter(F.transform(F.split(F.col("drug_mentions"), ","), rules.norm_key),
                                      lambda x: x != F.lit("")))
    per = (posts.select("score", F.explode_outer(names).alias("drug_name"))
           .groupBy("drug_name").agg(F.avg("score").alias("avg_score"),
                                     F.min("score").alias("mn"), F.max("score").alias("mx")))
    rng = per.agg(F.struct(F.min("mn").cast("double").alias("lo"), F.max("mx").cast("double").alias("hi"))).scalar()
    lo, hi = rng["lo"], rng["hi"]
    scaled = F.lit(100.0) * F.try_divide(F.col("avg_score") - lo, hi - lo)
    concern = (F.when(F.col("avg_score").isNull() | lo.isNull(), F.lit(0.0))
               .when(hi == lo, F.lit(50.0))
               .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), scaled))))
    return per.filter(F.col("drug_name").isNotNull()).select("drug_name", concern.alias("concern"))


def research_consensus(articles: DataFrame, terms: Sequence[str] = NEGATIVE_RESEARCH_TERMS) -> DataFrame:
    """Per drug (case-insensitive key), paper count and % of abstracts with any term."""
    neg = F.when(contains_any("abstract", terms), 1).otherwise(0)
    return (articles.filter(F.col("drug_name").isNotNull())
            .groupBy(F.upper(F.col("drug_name")).alias("drug_name"))
            .agg(F.count(F.lit(1)).alias("total"), (F.lit(100.0) * F.avg(neg)).alias("consensus")))


def label_override(master: DataFrame, labels: DataFrame) -> DataFrame:
    """The first label (smallest drug_id) whose brand matches the drug case-insensitively
    overrides the master's label values when its own value is not null."""
    first = dedup_latest(labels.withColumn("_bk", F.upper("brand_name")), "_bk", ["drug_id"])
    lb = first.select("_bk", F.col("warnings_length").alias("_wl"), F.col("interactions").alias("_it"))
    j = master.join(lb, F.upper(master["drug_name"]) == lb["_bk"], "left")
    wl = F.coalesce(F.col("_wl"), F.col("lbl_warnings_length"))
    it = F.coalesce(F.col("_it"), F.col("lbl_interactions"))
    return j.select("drug_name", wl.alias("warnings_length"), rules.label_severity(wl).alias("severity"),
                    rules.split_interactions(it).alias("known_interactions"))


def validate_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid requests, rejected requests with reason)."""
    from pvspark.operators.validate import request_rules, split_valid
    return split_valid(requests, request_rules())


def lookup(requests: DataFrame, master: DataFrame, key_mode: str = "normalized") -> tuple[DataFrame, DataFrame]:
    """Requests found in the master (inner join) and not found (left anti join).
    ``normalized`` applies P7 to the request key first; ``exact`` is the reference's rule."""
    key: Column = rules.norm_key("drug_name") if key_mode == "normalized" else F.col("drug_name")
    req = requests.withColumn("lookup_key", key)
    m = master.withColumnRenamed("drug_name", "lookup_key")
    return req.join(m, "lookup_key", "inner"), req.join(m, "lookup_key", "left_anti")
