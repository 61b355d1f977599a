"""DuckDB CTEs for the silver and gold layers, written independently of the Spark code so the
oracle is a second implementation of the same rules, not a transcription of the plan."""

from __future__ import annotations

from pvspark.plans.base import age_group_sql, int_guard
from pvspark.sources.fixtures import oracle_ctes

REPORT_ORDER = "ingestion_ts DESC NULLS LAST, tie1, tie2, tie3, tie4"

SILVER_REPORTS = f"""
silver_reports AS (
  SELECT report_id, drug_name, reaction, severity, age, weight, report_date,
         {age_group_sql('age')} AS age_group, (severity = 1) AS is_serious,
         hospitalization, death, disability, ingestion_ts
  FROM (
    SELECT report_id, upper(trim(drug_name)) AS drug_name, reaction,
           {int_guard('severity')} AS severity, {int_guard('age')} AS age,
           TRY_CAST(weight AS DOUBLE) AS weight,
           TRY_CAST(try_strptime(report_date, '%Y%m%d') AS DATE) AS report_date,
           coalesce({int_guard('hospitalization')}, 0) AS hospitalization,
           coalesce({int_guard('death')}, 0) AS death,
           coalesce({int_guard('disability')}, 0) AS disability,
           ingestion_ts,
           row_number() OVER (PARTITION BY report_id ORDER BY {REPORT_ORDER}) AS rn
    FROM reports_raw
    WHERE drug_name IS NOT NULL AND length(trim(drug_name)) > 0
  ) WHERE rn = 1
)"""

SILVER_POSTS = """
silver_posts AS (
  SELECT post_id, subreddit, title, body, score, created_utc, drug_mentions,
         CAST(length(body) AS INTEGER) AS body_length, CAST(hour(created_utc) AS INTEGER) AS hour_of_day
  FROM (
    SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY created_utc DESC NULLS LAST, tie1) AS rn
    FROM posts_raw WHERE body IS NOT NULL AND length(body) > 0
  ) WHERE rn = 1
)"""

SILVER_ARTICLES = """
silver_articles AS (
  SELECT article_id, title, abstract, publish_date, drug_name,
         CAST(length(abstract) AS INTEGER) AS abstract_length,
         CAST(year(publish_date) AS INTEGER) AS publish_year
  FROM (
    SELECT article_id, title, abstract, TRY_CAST(publish_date AS DATE) AS publish_date,
           upper(trim(drug_name)) AS drug_name,
           row_number() OVER (PARTITION BY article_id ORDER BY title, abstract, publish_date, drug_name) AS rn
    FROM articles_raw WHERE abstract IS NOT NULL AND length(abstract) >= 10
  ) WHERE rn = 1
)"""

SILVER_LABELS = """
silver_labels AS (
  SELECT drug_id, upper(trim(brand_name)) AS brand_name, upper(trim(generic_name)) AS generic_name,
         warnings, interactions,
         (interactions IS NOT NULL AND length(interactions) > 10) AS has_interactions,
         CAST(length(warnings) AS INTEGER) AS warnings_length
  FROM (
    SELECT *, row_number() OVER (PARTITION BY drug_id
                                 ORDER BY brand_name, generic_name, warnings, interactions) AS rn
    FROM labels_raw WHERE NOT (brand_name = 'unknown' AND generic_name = 'unknown')
  ) WHERE rn = 1
)"""

ADVERSE = """
adv_rc AS (SELECT drug_name, reaction, count(*) AS n FROM silver_reports
           WHERE reaction IS NOT NULL GROUP BY drug_name, reaction),
adv_tr AS (SELECT drug_name, reaction AS most_common_reaction, n FROM (
             SELECT *, row_number() OVER (PARTITION BY drug_name ORDER BY n DESC, reaction) AS rn
             FROM adv_rc) WHERE rn = 1),
adv_agc AS (SELECT drug_name, age_group, count(*) AS c FROM silver_reports GROUP BY drug_name, age_group),
adv_aga AS (SELECT drug_name,
                   '{' || string_agg('"' || age_group || '":' || CAST(c AS VARCHAR), ',' ORDER BY age_group) || '}'
                     AS age_group_distribution,
                   '[' || string_agg('{"age_group":"' || age_group || '","ag_cnt":' || CAST(c AS VARCHAR) || '}',
                                     ',' ORDER BY age_group) || ']' AS age_group_array
            FROM adv_agc GROUP BY drug_name),
adv_m AS (SELECT drug_name, count(*) AS total_reports,
                 CAST(sum(CASE WHEN is_serious THEN 1 ELSE 0 END) AS BIGINT) AS serious_reports,
                 CAST(sum(CASE WHEN hospitalization = 1 THEN 1 ELSE 0 END) AS BIGINT) AS hospitalization_reports,
                 CAST(sum(CASE WHEN death = 1 THEN 1 ELSE 0 END) AS BIGINT) AS death_reports,
                 CAST(sum(CASE WHEN disability = 1 THEN 1 ELSE 0 END) AS BIGINT) AS disability_reports,
                 avg(age) AS avg_age
          FROM silver_reports GROUP BY drug_name),
adverse AS (SELECT m.*, tr.most_common_reaction, aga.age_group_distribution
            FROM adv_m m LEFT JOIN adv_tr tr ON m.drug_name = tr.drug_name
                         LEFT JOIN adv_aga aga ON m.drug_name = aga.drug_name)"""


def sentiment(key_expr: str = "upper(trim(m))") -> str:
    return f"""
mentions AS (SELECT post_id, subreddit, score, body_length, {key_expr} AS drug_name
             FROM silver_posts, unnest(string_split(drug_mentions, ',')) AS u(m)
             WHERE drug_mentions IS NOT NULL),
sentiment AS (SELECT drug_name, count(*) AS total_mentions, avg(score) AS avg_score,
                     count(DISTINCT subreddit) AS subreddit_count, avg(body_length) AS avg_body_length
              FROM mentions WHERE drug_name IS NOT NULL AND drug_name <> '' GROUP BY drug_name)"""


RESEARCH = """
research AS (SELECT drug_name, count(*) AS total_papers, avg(abstract_length) AS avg_abstract_length,
                    max(publish_year) AS latest_publish_year, min(publish_year) AS earliest_publish_year
             FROM silver_articles WHERE drug_name IS NOT NULL GROUP BY drug_name)"""

LABELS_ONE = """
labels_pick AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY brand_name ORDER BY drug_id) AS rn FROM silver_labels) WHERE rn = 1)"""

LABELS_ALL = """
labels_pick AS (SELECT * FROM silver_labels)"""


def master(label_pick: str = "one") -> str:
    return (LABELS_ONE if label_pick == "one" else LABELS_ALL) + """,
master AS (
  SELECT a.drug_name,
    a.total_reports AS adv_total_reports, a.serious_reports AS adv_serious_reports,
    a.hospitalization_reports AS adv_hospitalization_reports, a.death_reports AS adv_death_reports,
    a.disability_reports AS adv_disability_reports, a.avg_age AS adv_avg_age,
    a.most_common_reaction AS adv_most_common_reaction,
    a.age_group_distribution AS adv_age_group_distribution,
    coalesce(s.total_mentions, 0) AS sent_total_mentions, s.avg_score AS sent_avg_score,
    s.subreddit_count AS sent_subreddit_count, s.avg_body_length AS sent_avg_body_length,
    r.total_papers AS res_total_papers, r.avg_abstract_length AS res_avg_abstract_length,
    r.latest_publish_year AS res_latest_publish_year, r.earliest_publish_year AS res_earliest_publish_year,
    l.drug_id AS lbl_drug_id, l.brand_name AS lbl_brand_name, l.generic_name AS lbl_generic_name,
    l.warnings AS lbl_warnings, l.interactions AS lbl_interactions,
    l.has_interactions AS lbl_has_interactions, l.warnings_length AS lbl_warnings_length
  FROM adverse a
  LEFT JOIN sentiment s ON a.drug_name = s.drug_name
  LEFT JOIN research r ON a.drug_name = r.drug_name
  LEFT JOIN labels_pick l ON a.drug_name = l.brand_name
)"""


def with_layers(adapters: list[str], *ctes: str) -> str:
    """Adapters + the requested CTE bodies as one WITH clause."""
    head = oracle_ctes(*adapters)
    return head + "".join("," + c for c in ctes)
