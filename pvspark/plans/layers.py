"""Silver and gold queries (build steps 1-3): clean tables, dedup, marts, master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pvspark.operators import marts, silver
from pvspark.plans import oracle_ctes as O
from pvspark.plans.base import r6, register, round_doubles
from pvspark.sources import fixtures

REPORT_ORDER = ["ingestion_ts desc", "tie1", "tie2", "tie3", "tie4"]
POST_ORDER = ["created_utc desc", "tie1"]


# ---- silver builders used by every downstream query --------------------------------------

def silver_reports_df(spark: SparkSession, sf_dir: str, method: str = "window") -> DataFrame:
    raw = fixtures.reports_raw(spark, sf_dir)
    return silver.clean_reports(raw, REPORT_ORDER, dedup_method=method).drop("tie1", "tie2", "tie3", "tie4")


def silver_posts_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_posts(fixtures.posts_raw(spark, sf_dir), POST_ORDER).drop("tie1")


def silver_articles_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_articles(fixtures.articles_raw(spark, sf_dir))


def silver_labels_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_labels(fixtures.labels_raw(spark, sf_dir))


def adverse_df(spark, sf_dir, dist="object"):
    return marts.adverse_profile(silver_reports_df(spark, sf_dir), dist)


def master_df(spark, sf_dir, key_mode="normalized", label_pick="one"):
    return marts.build_master(silver_reports_df(spark, sf_dir), silver_posts_df(spark, sf_dir),
                              silver_articles_df(spark, sf_dir), silver_labels_df(spark, sf_dir),
                              key_mode, label_pick)


# ---- step 1: reports -> adverse mart ------------------------------------------------------

REPORT_COLS = ["report_id", "drug_name", "reaction", "severity", "age", "weight", "report_date",
               "age_group", "is_serious", "hospitalization", "death", "disability"]


@register("silver_reports", O.with_layers(["reports_raw"], O.SILVER_REPORTS)
          + "\nSELECT " + ", ".join(c if c != "weight" else "round(weight, 6) AS weight" for c in REPORT_COLS)
          + " FROM silver_reports")
def q_silver_reports(spark, sf_dir):
    return round_doubles(silver_reports_df(spark, sf_dir).select(*REPORT_COLS))


@register("dedup_latest", O.oracle_ctes("reports_raw") + """
SELECT report_id, CAST(ingestion_ts AS VARCHAR) AS ingestion_ts, tie1 FROM (
  SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY """ + O.REPORT_ORDER + """) AS rn
  FROM reports_raw) WHERE rn = 1""")
def q_dedup_latest(spark, sf_dir):
    """W2 on its own over every raw report row (no blank filter): survivor per report_id."""
    from pvspark.operators.dedup import dedup_latest
    raw = fixtures.reports_raw(spark, sf_dir)
    d = dedup_latest(raw, "report_id", REPORT_ORDER)
    return d.select("report_id", F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss").alias("ingestion_ts"), "tie1")


@register("dedup_latest_min_by", O.oracle_ctes("reports_raw") + """
SELECT report_id, CAST(ingestion_ts AS VARCHAR) AS ingestion_ts, tie1 FROM (
  SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY """ + O.REPORT_ORDER + """) AS rn
  FROM reports_raw) WHERE rn = 1""")
def q_dedup_latest_min_by(spark, sf_dir):
    """Same survivor chosen through partial aggregation (min_by over an order struct)."""
    from pvspark.operators.dedup import dedup_latest
    d = dedup_latest(fixtures.reports_raw(spark, sf_dir), "report_id", REPORT_ORDER, method="min_by")
    return d.select("report_id", F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss").alias("ingestion_ts"), "tie1")


@register("age_group_dist", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE)
          + "\nSELECT drug_name, age_group_distribution FROM adv_aga")
def q_age_group_dist(spark, sf_dir):
    return marts.age_distribution(marts.adverse_cube(silver_reports_df(spark, sf_dir)), "object")


@register("age_group_array", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE)
          + "\nSELECT drug_name, age_group_array AS age_group_distribution FROM adv_aga")
def q_age_group_array(spark, sf_dir):
    return marts.age_distribution(marts.adverse_cube(silver_reports_df(spark, sf_dir)), "array")


@register("top_reaction", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE)
          + "\nSELECT drug_name, most_common_reaction, n FROM adv_tr")
def q_top_reaction(spark, sf_dir):
    return marts.top_reaction(marts.reaction_counts(marts.adverse_cube(silver_reports_df(spark, sf_dir))))


@register("top5_reactions", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE) + """
SELECT drug_name, CAST(rank AS INTEGER) AS rank, reaction, n, round(100.0::DOUBLE * n / denom, 6) AS frequency_pct
FROM (SELECT *, row_number() OVER (PARTITION BY drug_name ORDER BY n DESC, reaction) AS rank,
             sum(n) OVER (PARTITION BY drug_name) AS denom FROM adv_rc) WHERE rank <= 5""")
def q_top5_reactions(spark, sf_dir):
    """The real top-5 list with frequency share (denominator = rows with a reaction)."""
    t = marts.top_reactions(marts.reaction_counts(marts.adverse_cube(silver_reports_df(spark, sf_dir))), 5)
    return t.select("drug_name", F.col("rank").cast("int").alias("rank"), "reaction", "n",
                    r6("frequency_pct").alias("frequency_pct"))


ADV_COLS = ["drug_name", "total_reports", "serious_reports", "hospitalization_reports", "death_reports",
            "disability_reports", "avg_age", "most_common_reaction", "age_group_distribution"]


@register("mart_adverse_profile", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE)
          + "\nSELECT " + ", ".join("round(avg_age, 6) AS avg_age" if c == "avg_age" else c for c in ADV_COLS)
          + " FROM adverse")
def q_mart_adverse_profile(spark, sf_dir):
    return round_doubles(adverse_df(spark, sf_dir).select(*ADV_COLS))


@register("invariant_serious", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE)
          + "\nSELECT drug_name, serious_reports, total_reports FROM adverse WHERE serious_reports > total_reports")
def q_invariant_serious(spark, sf_dir):
    return marts.invariant_serious(adverse_df(spark, sf_dir)).select("drug_name", "serious_reports", "total_reports")


@register("invariant_violations", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE) + """
SELECT drug_name, serious_reports, hospitalization_reports AS total_reports
FROM adverse WHERE serious_reports > hospitalization_reports""")
def q_invariant_violations(spark, sf_dir):
    """Q10 on a mart whose total was filled from the wrong column: the drugs that the check has to name."""
    wrong = adverse_df(spark, sf_dir).withColumn("total_reports", F.col("hospitalization_reports"))
    return marts.invariant_serious(wrong).select("drug_name", "serious_reports", "total_reports")


@register("outcome_rates", O.with_layers(["reports_raw"], O.SILVER_REPORTS, O.ADVERSE) + """
SELECT drug_name,
  round(serious_reports / CAST(total_reports AS DOUBLE), 6) AS serious_rate,
  round(hospitalization_reports / CAST(total_reports AS DOUBLE), 6) AS hospitalization_rate,
  round(death_reports / CAST(total_reports AS DOUBLE), 6) AS death_rate,
  round(disability_reports / CAST(total_reports AS DOUBLE), 6) AS disability_rate
FROM adverse WHERE total_reports > 0""")
def q_outcome_rates(spark, sf_dir):
    return round_doubles(marts.outcome_rates(adverse_df(spark, sf_dir)))


# ---- step 2: other silver tables and marts ------------------------------------------------

@register("silver_posts", O.with_layers(["posts_raw"], O.SILVER_POSTS) + """
SELECT post_id, subreddit, score, body_length, hour_of_day, drug_mentions AS drug_list FROM silver_posts""")
def q_silver_posts(spark, sf_dir):
    return silver_posts_df(spark, sf_dir).select(
        "post_id", "subreddit", "score", "body_length", "hour_of_day",
        F.array_join("drug_list", ",").alias("drug_list"))


@register("silver_articles", O.with_layers(["articles_raw"], O.SILVER_ARTICLES) + """
SELECT article_id, drug_name, publish_date, publish_year, abstract_length FROM silver_articles""")
def q_silver_articles(spark, sf_dir):
    return silver_articles_df(spark, sf_dir).select("article_id", "drug_name", "publish_date", "publish_year",
                                                    "abstract_length")


@register("silver_labels", O.with_layers(["labels_raw"], O.SILVER_LABELS) + """
SELECT drug_id, brand_name, generic_name, has_interactions, warnings_length FROM silver_labels""")
def q_silver_labels(spark, sf_dir):
    return silver_labels_df(spark, sf_dir).select("drug_id", "brand_name", "generic_name", "has_interactions",
                                                  "warnings_length")


@register("explode_mentions", O.with_layers(["posts_raw"], O.SILVER_POSTS) + """
SELECT post_id, upper(trim(m)) AS drug_name
FROM silver_posts, unnest(string_split(drug_mentions, ',')) AS u(m) WHERE drug_mentions IS NOT NULL""")
def q_explode_mentions(spark, sf_dir):
    return marts.explode_mentions(silver_posts_df(spark, sf_dir)).select("post_id", "drug_name")


@register("mart_sentiment_profile", O.with_layers(["posts_raw"], O.SILVER_POSTS, O.sentiment()) + """
SELECT drug_name, total_mentions, round(avg_score, 6) AS avg_score, subreddit_count,
       round(avg_body_length, 6) AS avg_body_length FROM sentiment""")
def q_mart_sentiment_profile(spark, sf_dir):
    return round_doubles(marts.sentiment_profile(silver_posts_df(spark, sf_dir)))


@register("mart_sentiment_merged", O.with_layers(["posts_raw"], O.SILVER_POSTS, O.sentiment()) + """
SELECT drug_name, total_mentions, round(avg_score, 6) AS avg_score, subreddit_count,
       round(avg_body_length, 6) AS avg_body_length FROM sentiment""")
def q_mart_sentiment_merged(spark, sf_dir):
    """A3 from daily states with sketches of the forums (few here, so the estimate is exact)."""
    return round_doubles(marts.sentiment_merge(marts.sentiment_daily(silver_posts_df(spark, sf_dir))))


@register("mart_sentiment_exact_keys", O.with_layers(["posts_raw"], O.SILVER_POSTS, O.sentiment("trim(m)")) + """
SELECT drug_name, total_mentions, round(avg_score, 6) AS avg_score, subreddit_count,
       round(avg_body_length, 6) AS avg_body_length FROM sentiment""")
def q_mart_sentiment_exact(spark, sf_dir):
    return round_doubles(marts.sentiment_profile(silver_posts_df(spark, sf_dir), key_mode="exact"))


@register("mart_research_profile", O.with_layers(["articles_raw"], O.SILVER_ARTICLES, O.RESEARCH) + """
SELECT drug_name, total_papers, round(avg_abstract_length, 6) AS avg_abstract_length,
       latest_publish_year, earliest_publish_year FROM research""")
def q_mart_research_profile(spark, sf_dir):
    return round_doubles(marts.research_profile(silver_articles_df(spark, sf_dir)))


# ---- step 3: master ------------------------------------------------------------------------

MASTER_ROUND = {"adv_avg_age", "sent_avg_score", "sent_avg_body_length", "res_avg_abstract_length"}
MASTER_COLS = ["drug_name", "adv_total_reports", "adv_serious_reports", "adv_hospitalization_reports",
               "adv_death_reports", "adv_disability_reports", "adv_avg_age", "adv_most_common_reaction",
               "adv_age_group_distribution", "sent_total_mentions", "sent_avg_score", "sent_subreddit_count",
               "sent_avg_body_length", "res_total_papers", "res_avg_abstract_length", "res_latest_publish_year",
               "res_earliest_publish_year", "lbl_drug_id", "lbl_brand_name", "lbl_generic_name", "lbl_warnings",
               "lbl_interactions", "lbl_has_interactions", "lbl_warnings_length"]
_MASTER_SELECT = "\nSELECT " + ", ".join(f"round({c}, 6) AS {c}" if c in MASTER_ROUND else c
                                         for c in MASTER_COLS) + " FROM master"


def _master_oracle(key_expr: str, label_pick: str) -> str:
    return O.with_layers(["reports_raw", "posts_raw", "articles_raw", "labels_raw"],
                         O.SILVER_REPORTS, O.SILVER_POSTS, O.SILVER_ARTICLES, O.SILVER_LABELS,
                         O.ADVERSE, O.sentiment(key_expr), O.RESEARCH, O.master(label_pick)) + _MASTER_SELECT


@register("mart_master", _master_oracle("upper(trim(m))", "one"))
def q_mart_master(spark, sf_dir):
    return round_doubles(master_df(spark, sf_dir).select(*MASTER_COLS))


@register("mart_master_exact_keys", _master_oracle("trim(m)", "one"))
def q_mart_master_exact(spark, sf_dir):
    return round_doubles(master_df(spark, sf_dir, key_mode="exact").select(*MASTER_COLS))


@register("mart_master_all_labels", _master_oracle("upper(trim(m))", "all"))
def q_mart_master_all_labels(spark, sf_dir):
    return round_doubles(master_df(spark, sf_dir, label_pick="all").select(*MASTER_COLS))
