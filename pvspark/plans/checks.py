"""Build steps 5-6: quality suites, mart tests, KPIs, label override, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from pvspark.functions import text
from pvspark.operators import kpi, quality
from pvspark.plans import oracle_ctes as O
from pvspark.plans.base import register, round_doubles
from pvspark.plans.layers import master_df, silver_articles_df, silver_labels_df, silver_posts_df
from pvspark.sources import fixtures
from pvspark.sources.tables import read_table


def _sql_str_list(xs) -> str:
    return ", ".join("'" + str(x).replace("'", "''") + "'" for x in xs)


def _suite_sql(suite: str, table: str, checks) -> str:
    """Second, independent statement of the check semantics: one SELECT per check."""
    parts = []
    for i, ch in enumerate(checks):
        c = ch.column
        head = f"SELECT '{suite}' AS suite, {i} AS pos, '{ch.kind}' AS check_name, '{c}' AS column_name"
        if ch.kind == "unique":
            parts.append(f"""{head}, (SELECT count(*) FROM {table}) AS total,
  CAST(coalesce((SELECT sum(k) FROM (SELECT {c}, count(*) AS k FROM {table} WHERE {c} IS NOT NULL
                                     GROUP BY {c} HAVING count(*) > 1)), 0) AS BIGINT) AS unexpected""")
            continue
        if ch.kind == "not_null":
            cond = f"{c} IS NULL"
        elif ch.kind == "in_set":
            cond = f"{c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN ({_sql_str_list(ch.args)})"
        elif ch.kind == "between":
            x = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
            cond = f"{c} IS NOT NULL AND ({x} IS NULL OR {x} < {ch.args[0]} OR {x} > {ch.args[1]})"
        elif ch.kind == "regex":
            cond = f"{c} IS NOT NULL AND NOT regexp_matches(CAST({c} AS VARCHAR), '{ch.args[0]}')"
        elif ch.kind == "length_between":
            n = f"length(CAST({c} AS VARCHAR))"
            cond = f"{c} IS NOT NULL AND ({n} < {ch.args[0]} OR {n} > {ch.args[1]})"
        else:
            raise ValueError(ch.kind)
        parts.append(f"{head}, count(*) AS total, count(*) FILTER (WHERE {cond}) AS unexpected FROM {table}")
    body = "\nUNION ALL\n".join(f"SELECT *, unexpected = 0 AS success FROM ({p})" for p in parts)
    return body


def _suite_query(name: str, raw_fn):
    def q(spark, sf_dir):
        return quality.run_named_suite(raw_fn(spark, sf_dir), name)
    return q


for _suite, _adapter, _fn in (("reports", "reports_raw", fixtures.reports_raw),
                              ("articles", "articles_raw", fixtures.articles_raw),
                              ("posts", "posts_raw", fixtures.posts_raw),
                              ("labels", "labels_raw", fixtures.labels_raw)):
    register(f"suite_{_suite}", fixtures.oracle_ctes(_adapter) + "\n"
             + _suite_sql(_suite, _adapter, quality.SUITES[_suite]))(_suite_query(_suite, _fn))


_MASTER_CTES = O.with_layers(["reports_raw", "posts_raw", "articles_raw", "labels_raw"],
                             O.SILVER_REPORTS, O.SILVER_POSTS, O.SILVER_ARTICLES, O.SILVER_LABELS,
                             O.ADVERSE, O.sentiment(), O.RESEARCH, O.master("one"))

_MART_CHECKS = [quality.not_null("drug_name"), quality.unique("drug_name"),
                quality.not_null("adv_total_reports"), quality.not_null("sent_total_mentions")]


@register("mart_tests", _MASTER_CTES + "\n" + _suite_sql("master", "master", _MART_CHECKS))
def q_mart_tests(spark, sf_dir):
    """Q9 on the master table."""
    return quality.mart_tests(master_df(spark, sf_dir))


@register("mart_tests_all_labels", O.with_layers(
    ["reports_raw", "posts_raw", "articles_raw", "labels_raw"], O.SILVER_REPORTS, O.SILVER_POSTS,
    O.SILVER_ARTICLES, O.SILVER_LABELS, O.ADVERSE, O.sentiment(), O.RESEARCH, O.master("all"))
    + "\n" + _suite_sql("master", "master", _MART_CHECKS))
def q_mart_tests_all_labels(spark, sf_dir):
    """Q9 on the reference's fan-out master: the uniqueness test flags the duplicated drugs (F2)."""
    return quality.mart_tests(master_df(spark, sf_dir, label_pick="all"))


# ---- KPIs ----------------------------------------------------------------------------------

DEP_TERMS = ["error"]        # fixture term lists (the forum fixture has no dependency vocabulary)
WD_TERMS = ["signup"]

_PM = """
pm AS (SELECT DISTINCT post_id, body, score, upper(trim(m)) AS drug_name
       FROM silver_posts, unnest(string_split(drug_mentions, ',')) AS u(m)
       WHERE drug_mentions IS NOT NULL AND upper(trim(m)) <> '')"""


def _any_sql(col: str, terms) -> str:
    return f"len(list_filter([{_sql_str_list(t.lower() for t in terms)}], lambda k: contains(lower(coalesce({col}, '')), k))) > 0"


@register("mention_rates", O.with_layers(["posts_raw"], O.SILVER_POSTS, _PM) + f"""
SELECT drug_name, count(*) AS total,
  round(100.0::DOUBLE * avg(CASE WHEN {_any_sql('body', DEP_TERMS)} THEN 1 ELSE 0 END), 6) AS dependency_rate,
  round(100.0::DOUBLE * avg(CASE WHEN {_any_sql('body', WD_TERMS)} THEN 1 ELSE 0 END), 6) AS withdrawal_rate
FROM pm GROUP BY drug_name""")
def q_mention_rates(spark, sf_dir):
    return round_doubles(kpi.mention_rates(silver_posts_df(spark, sf_dir), DEP_TERMS, WD_TERMS))


@register("mention_rates_substring", O.with_layers(["posts_raw", "reports_raw"], O.SILVER_POSTS, O.SILVER_REPORTS)
          + f"""
, drugs AS (SELECT DISTINCT drug_name FROM silver_reports WHERE drug_name IS NOT NULL AND drug_name <> ''),
ps AS (SELECT p.post_id, p.body, d.drug_name FROM silver_posts p JOIN drugs d
       ON contains(lower(p.drug_mentions), lower(d.drug_name)) WHERE p.drug_mentions IS NOT NULL)
SELECT drug_name, count(*) AS total,
  round(100.0::DOUBLE * avg(CASE WHEN {_any_sql('body', DEP_TERMS)} THEN 1 ELSE 0 END), 6) AS dependency_rate,
  round(100.0::DOUBLE * avg(CASE WHEN {_any_sql('body', WD_TERMS)} THEN 1 ELSE 0 END), 6) AS withdrawal_rate
FROM ps GROUP BY drug_name""")
def q_mention_rates_substring(spark, sf_dir):
    """J6 with the reference's substring rule (case-insensitive, literal) against the report
    drugs; the oracle forms the post x drug cross join, the Spark plan does not."""
    from pvspark.plans.layers import silver_reports_df
    drugs = silver_reports_df(spark, sf_dir).select("drug_name").distinct()
    return round_doubles(kpi.mention_rates(silver_posts_df(spark, sf_dir), DEP_TERMS, WD_TERMS,
                                           match="substring", drugs=drugs))


@register("concern_score", O.with_layers(["posts_raw"], O.SILVER_POSTS, _PM) + """
, g AS (SELECT CAST(min(score) AS DOUBLE) AS lo, CAST(max(score) AS DOUBLE) AS hi FROM silver_posts),
per AS (SELECT drug_name, avg(score) AS a FROM pm GROUP BY drug_name)
SELECT drug_name, round(CASE WHEN a IS NULL OR lo IS NULL THEN 0.0 WHEN hi = lo THEN 50.0
  ELSE greatest(0.0, least(100.0, 100.0 * (a - lo) / (hi - lo))) END, 6) AS concern
FROM per, g""")
def q_concern_score(spark, sf_dir):
    return round_doubles(kpi.concern_score(silver_posts_df(spark, sf_dir)))


@register("research_consensus", O.with_layers(["articles_raw"], O.SILVER_ARTICLES) + f"""
SELECT upper(drug_name) AS drug_name, count(*) AS total,
  round(100.0::DOUBLE * avg(CASE WHEN {_any_sql('abstract', text.NEGATIVE_RESEARCH_TERMS)} THEN 1 ELSE 0 END), 6)
    AS consensus
FROM silver_articles WHERE drug_name IS NOT NULL GROUP BY upper(drug_name)""")
def q_research_consensus(spark, sf_dir):
    return round_doubles(kpi.research_consensus(silver_articles_df(spark, sf_dir)))


_STRIP = "regexp_replace(p, '^\\s+|\\s+$', '', 'g')"


@register("label_override", _MASTER_CTES + f"""
, lf AS (SELECT upper(brand_name) AS bk, warnings_length AS wl, interactions AS it FROM (
           SELECT *, row_number() OVER (PARTITION BY upper(brand_name) ORDER BY drug_id) AS rn FROM silver_labels)
         WHERE rn = 1),
j AS (SELECT m.drug_name, coalesce(lf.wl, m.lbl_warnings_length) AS wl, coalesce(lf.it, m.lbl_interactions) AS it
      FROM master m LEFT JOIN lf ON upper(m.drug_name) = lf.bk)
SELECT drug_name, wl AS warnings_length,
  CASE WHEN wl IS NULL OR wl < 500 THEN 'LOW' WHEN wl < 2000 THEN 'MEDIUM' ELSE 'HIGH' END AS severity,
  array_to_string(list_filter(list_transform(string_split(coalesce(it, ''), ','), lambda p: {_STRIP}),
                              lambda p: p <> ''), ',') AS known_interactions
FROM j""")
def q_label_override(spark, sf_dir):
    o = kpi.label_override(master_df(spark, sf_dir), silver_labels_df(spark, sf_dir))
    return o.withColumn("known_interactions", F.array_join("known_interactions", ","))


AGES = [5, 30, 70, 130]
WEIGHTS = [0.0, 70.0]


def requests_df(spark, sf_dir):
    """Scoring requests: every part name with its first letter capitalised and in capitals, and names of no drug
    (one for each brand), x ages x weights."""
    part = read_table(spark, sf_dir, "part")
    names = part.select(F.explode(F.array(
        F.concat(F.upper(F.substring("p_name", 1, 1)), F.substring("p_name", 2, 1 << 30)), F.upper("p_name"),
        F.concat(F.lit("No "), F.col("p_brand")))).alias("drug_name")).distinct()
    return (names.select("drug_name", F.explode(F.array(*[F.lit(a) for a in AGES])).alias("age"))
            .select("drug_name", "age", F.explode(F.array(*[F.lit(w) for w in WEIGHTS])).alias("weight")))


_REQ = f"""
, req AS (SELECT d.drug_name, a.age, CAST(w.weight AS DOUBLE) AS weight
          FROM (SELECT upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS drug_name FROM part
                UNION SELECT upper(p_name) FROM part UNION SELECT 'No ' || p_brand FROM part) d,
               (SELECT unnest([{", ".join(map(str, AGES))}]) AS age) a,
               (SELECT unnest([{", ".join(map(str, WEIGHTS))}]) AS weight) w),
valid AS (SELECT * FROM req WHERE drug_name IS NOT NULL AND drug_name <> '' AND age BETWEEN 0 AND 120
                                AND weight > 0 AND weight <= 500)"""


@register("lookup_found", _MASTER_CTES + _REQ + """
SELECT v.drug_name, v.age, v.weight, m.drug_name AS lookup_key, m.adv_total_reports
FROM valid v JOIN master m ON upper(trim(v.drug_name)) = m.drug_name""")
def q_lookup_found(spark, sf_dir):
    """P22 + P7 + J4: valid requests matched to the master on the normalised key."""
    valid, _ = kpi.validate_requests(requests_df(spark, sf_dir))
    found, _ = kpi.lookup(valid, master_df(spark, sf_dir).select("drug_name", "adv_total_reports"))
    return found.select("drug_name", "age", "weight", "lookup_key", "adv_total_reports")


# both keys are computed text, and the master's are listed once: dictionary-encoded names never meet in the join
@register("lookup_missing", _MASTER_CTES + _REQ + """,
known AS MATERIALIZED (SELECT DISTINCT concat(drug_name, '#') AS k FROM master),
asked AS MATERIALIZED (SELECT concat(drug_name, '#') AS k, age, weight FROM valid)
SELECT left(a.k, -1) AS drug_name, a.age, a.weight FROM asked a LEFT JOIN known ON known.k = a.k WHERE known.k IS NULL""")
def q_lookup_missing(spark, sf_dir):
    """J4 with the reference's exact key rule: mixed-case requests are not found."""
    valid, _ = kpi.validate_requests(requests_df(spark, sf_dir))
    _, missing = kpi.lookup(valid, master_df(spark, sf_dir).select("drug_name"), key_mode="exact")
    return missing.select("drug_name", "age", "weight")


@register("request_rejects", _REQ.lstrip().lstrip(",").replace("req AS", "WITH req AS", 1) + """
SELECT drug_name, age, weight, CASE WHEN age < 0 OR age > 120 THEN 'age out of range'
  ELSE 'weight out of range' END AS reject_reason
FROM req WHERE NOT (age BETWEEN 0 AND 120 AND weight > 0 AND weight <= 500)""")
def q_request_rejects(spark, sf_dir):
    """Rejected requests with the first failing rule."""
    _, rejected = kpi.validate_requests(requests_df(spark, sf_dir))
    return rejected.select("drug_name", "age", "weight", "reject_reason")

