"""Build step 10: published projection, target router, clean-layer runner counts."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pvspark.operators import jobs, marts, quality, sinks, validate
from pvspark.plans import oracle_ctes as O
from pvspark.plans.base import register, round_doubles
from pvspark.plans.layers import (MASTER_COLS, POST_ORDER, REPORT_ORDER, _master_oracle, silver_articles_df, silver_labels_df,
                                  silver_posts_df, silver_reports_df)
from pvspark.session import scratch_path
from pvspark.sources import fixtures
from pvspark.sources.tables import read_catalog_table, read_table

# Published schema of the reports plus one column the silver table does not have (-> NULL).
PUBLISHED = sinks.REPORTS_SCHEMA + [("source_batch", "VARCHAR")]

_DUCK_TYPES = {"VARCHAR": "VARCHAR", "INTEGER": "INTEGER", "FLOAT": "FLOAT", "DATE": "DATE", "BOOLEAN": "BOOLEAN",
               "TIMESTAMP": "TIMESTAMP"}


def _publish_sql() -> str:
    cols = []
    for name, t in PUBLISHED:
        if name == "source_batch":
            cols.append(f"CAST(NULL AS VARCHAR) AS {name}")
        elif t == "FLOAT":
            cols.append(f"round(CAST(CAST({name} AS FLOAT) AS DOUBLE), 6) AS {name}")
        else:
            cols.append(f"CAST({name} AS {_DUCK_TYPES[t]}) AS {name}")
    return O.with_layers(["reports_raw"], O.SILVER_REPORTS) + "\nSELECT " + ", ".join(cols) + " FROM silver_reports"


@register("publish_projected", _publish_sql())
def q_publish_projected(spark, sf_dir):
    """P18 (+ K4/K5 projection): silver reports in the declared published schema."""
    out = sinks.project_to_schema(silver_reports_df(spark, sf_dir), PUBLISHED)
    return out.withColumn("weight", F.round(F.col("weight").cast("double"), 6))


@register("router_choice", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS start FROM orders),
t AS (SELECT max(CAST(o_orderdate AS DATE)) AS today FROM orders)
SELECT start, CAST(date_diff('day', start, today) AS INTEGER) AS days,
       CASE WHEN date_diff('day', start, today) <= 30 THEN 'append' ELSE 'overwrite' END AS target
FROM d, t""")
def q_router_choice(spark, sf_dir):
    """K6 over every distinct order date as a trial start, 'today' = the latest order date
    (a scalar subquery: one value, no join)."""
    o = read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("start"))
    today = o.agg(F.max("start")).scalar()
    d = o.distinct()
    return d.select("start", F.datediff(today, F.col("start")).alias("days"),
                    sinks.choose_target_col(F.col("start"), today).alias("target"))


@register("clean_all", O.with_layers(["reports_raw", "posts_raw", "articles_raw", "labels_raw"],
                                     O.SILVER_REPORTS, O.SILVER_POSTS, O.SILVER_ARTICLES, O.SILVER_LABELS) + """
SELECT 'reports' AS "table", (SELECT count(*) FROM reports_raw) AS rows_in, (SELECT count(*) FROM silver_reports) AS rows_out
UNION ALL SELECT 'articles', (SELECT count(*) FROM articles_raw), (SELECT count(*) FROM silver_articles)
UNION ALL SELECT 'posts', (SELECT count(*) FROM posts_raw), (SELECT count(*) FROM silver_posts)
UNION ALL SELECT 'labels', (SELECT count(*) FROM labels_raw), (SELECT count(*) FROM silver_labels)""")
def q_clean_all(spark, sf_dir):
    """The four clean transforms in order; rows in / rows out per table."""
    raw = {"reports": fixtures.reports_raw(spark, sf_dir), "articles": fixtures.articles_raw(spark, sf_dir),
           "posts": fixtures.posts_raw(spark, sf_dir), "labels": fixtures.labels_raw(spark, sf_dir)}
    clean = jobs.run_silver(raw, {"reports": REPORT_ORDER, "posts": POST_ORDER})
    return jobs.silver_counts(raw, clean)



@register("bronze_load", fixtures.oracle_ctes("reports_raw") + """
, r AS (SELECT * FROM reports_raw WHERE report_date NOT LIKE '1995%')
SELECT report_month, n, malformed FROM (
  SELECT substr(report_date, 1, 6) AS report_month, count(*) AS n, 0::BIGINT AS malformed FROM r GROUP BY 1
  UNION ALL SELECT 'malformed', 0, count(*) FROM r WHERE tie2 % 10 = 0)""")
def q_bronze_load(spark, sf_dir):
    """K1 + F4: every raw report written as the dated NDJSON batch and loaded into the raw table (typed DDL,
    partitioned by ds / report_month). The day is then run again with the reports of one year gone and with broken
    lines added: the table must lose those months, and the broken lines must be in quarantine."""
    root = scratch_path(spark, f"bronze-{uuid.uuid4().hex}")
    raw = fixtures.reports_raw(spark, sf_dir)
    plain = ["tie1", "tie2", "tie3", "tie4"]
    path = sinks.write_batch(raw.drop(*plain), f"{root}/raw", "faers", "2024-01-01")
    sinks.bronze_load(spark, path, f"{root}/faers_events", "faers_events", "2024-01-01")
    less = raw.filter(~F.col("report_date").startswith("1995"))
    lines = less.select(F.to_json(F.struct(*[c for c in raw.columns if c not in plain])).alias("value")).unionByName(
        less.filter("tie2 % 10 = 0").select(F.concat(F.lit('{"report_id": '), F.col("report_id"), F.lit(" oops")).alias("value")))
    lines.write.mode("overwrite").option("compression", "gzip").text(path)
    table = sinks.bronze_load(spark, path, f"{root}/faers_events", "faers_events", "2024-01-01")
    bad = sinks.quarantined(spark, f"{root}/faers_events", "2024-01-01")
    none = F.lit(0).cast("bigint")
    return (table.groupBy("report_month").agg(F.count(F.lit(1)).alias("n")).withColumn("malformed", none)
            .unionByName(bad.agg(F.count(F.lit(1)).alias("malformed")).withColumn("n", none)
                         .withColumn("report_month", F.lit("malformed"))))


_GATED = {
    # view, rows that the suite's bounds allow, id, valid, unique ids
    "reports": ("reports_raw", "TRUE", "report_id", "drug_name IS NOT NULL AND drug_name <> '' AND severity IN ('1', '2')", False),
    "articles": ("articles_raw", "length(abstract) BETWEEN 10 AND 10000", "article_id",
                 "title <> '' AND abstract <> ''", True),
    "posts": ("posts_raw", "TRUE", "post_id", "body <> ''", False),
    "labels": ("labels_raw", "warnings IS NOT NULL", "drug_id", "CAST(drug_id AS INT) % 9 <> 0", True),
}
ALL, MENDED = "2024-01-01", "2024-01-02"        # whole batches; the batches without what the suites forbid


def _gated_sql(t: str, day: str) -> str:
    v, bounds, _, ok, unique = _GATED[t]
    rows = f"(SELECT * FROM {v}" + (f" WHERE {bounds})" if day == MENDED else ")")
    good = f"count(*) FILTER (WHERE {ok})"
    out = f"CASE WHEN count(*) FILTER (WHERE ({ok}) AND NOT coalesce({bounds}, FALSE)) = 0 THEN {good} ELSE 0 END" if unique else "0::BIGINT"
    return f"""SELECT '{t}' AS source, '{day}' AS ds, {good} AS kept, count(*) FILTER (WHERE NOT coalesce({ok}, FALSE)) AS quarantined,
       {out} AS published FROM {rows}"""


_BATCHES = [(t, ALL) for t in _GATED] + [(t, MENDED) for t, g in _GATED.items() if g[4]]


@register("ingest_gated", fixtures.oracle_ctes("reports_raw", "posts_raw", "articles_raw", "labels_raw") + "\n"
          + "\nUNION ALL ".join(_gated_sql(t, day) for t, day in _BATCHES))
def q_ingest_gated(spark, sf_dir):
    """X4 + Q8 + A11: rows kept, rows quarantined (counted by the staging write), rows published. All rows of each source come on
    the first day: repeated ids, overlong abstracts and missing warnings must stop the gates. On the second day articles and labels
    come without the forbidden rows and are published."""
    root = scratch_path(spark, f"gated-{uuid.uuid4().hex}")
    raw = {"reports": fixtures.reports_raw(spark, sf_dir).drop("tie1", "tie2", "tie3", "tie4"),
           "articles": fixtures.articles_raw(spark, sf_dir), "posts": fixtures.posts_raw(spark, sf_dir).drop("tie1"),
           "labels": fixtures.labels_raw(spark, sf_dir).withColumn("openfda_present", F.col("drug_id").cast("int") % 9 != 0)}
    rows = []
    for source, day in _BATCHES:
        _, bounds, key, _, _ = _GATED[source]
        records = raw[source].filter(F.expr(bounds)) if day == MENDED else raw[source]
        try:
            done = jobs.run_ingest(spark, source, day, records, root)
            counts, n = done.counts, spark.read.schema(f"{key} string").json(done.published).count()
        except quality.QualityGateError as e:
            counts, n = e.counts, 0
        rows.append((source, day, counts["kept"], counts["dropped"], n))
    return spark.createDataFrame(rows, "source string, ds string, kept long, quarantined long, published long")


@register("raw_scan_ndjson", fixtures.oracle_ctes("posts_raw") + """
SELECT count(*) AS n, count(DISTINCT post_id) AS ids, sum(score)::BIGINT AS score,
       (SELECT count(*) FROM posts_raw WHERE tie1 % 101 = 0) AS malformed
FROM posts_raw WHERE tie1 % 101 <> 0""")
def q_raw_scan_ndjson(spark, sf_dir):
    """Posts written as JSON lines, some broken, scanned with a declared schema."""
    from pvspark.sources.tables import read_ndjson
    path = f"{scratch_path(spark, f'scan-{uuid.uuid4().hex}')}/in"
    posts = fixtures.posts_raw(spark, sf_dir)
    good = F.to_json(F.struct("post_id", "score"))
    posts.select(F.when(F.col("tie1") % 101 == 0, F.concat(F.lit("{broken "), F.col("post_id"))).otherwise(good).alias("value")) \
        .write.text(path)
    rows = read_ndjson(spark, path, spark.createDataFrame([], "post_id string, score int").schema)
    ok = F.col("_corrupt_record").isNull()
    return rows.agg(F.count_if(ok).alias("n"), F.count_distinct(F.when(ok, F.col("post_id"))).alias("ids"),
                    F.sum(F.when(ok, F.col("score"))).alias("score"), F.count_if(~ok).alias("malformed"))


@register("publish_routed", O.with_layers(["reports_raw"], O.SILVER_REPORTS) + """
SELECT 'append' AS target, 2 * count(*) AS n, 2 * count(*) FILTER (WHERE is_serious) AS serious FROM silver_reports
UNION ALL SELECT 'overwrite', count(*), count(*) FILTER (WHERE is_serious) FROM silver_reports""")
def q_publish_routed(spark, sf_dir):
    """K4 / K5 / K6: the router publishes the silver reports twice in the trial (append: twice the rows) and twice
    after it (overwrite: the rows once)."""
    root = scratch_path(spark, f"publish-{uuid.uuid4().hex}")
    reports = sinks.stage(silver_reports_df(spark, sf_dir), f"{root}/silver")
    start = dt.date(2024, 1, 1)
    out = None
    for day in (dt.date(2024, 1, 31), dt.date(2024, 2, 1)):
        for _ in range(2):
            target = sinks.route(reports, f"{root}/{day}", sinks.REPORTS_SCHEMA, "auto", start, day)
        got = spark.read.parquet(f"{root}/{day}").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_serious").alias("serious"))
        row = got.select(F.lit(target).alias("target"), "n", "serious")
        out = row if out is None else out.unionByName(row)
    return out


@register("clean_tables", O.with_layers(["reports_raw", "labels_raw"], O.SILVER_REPORTS, O.SILVER_LABELS, O.ADVERSE) + """
SELECT 'clean_reports' AS name, count(*) AS n FROM silver_reports
UNION ALL SELECT 'clean_labels', count(*) FROM silver_labels
UNION ALL SELECT 'mart_adverse', count(*) FROM adverse
UNION ALL SELECT 'stg_reports', count(*) FROM silver_reports
UNION ALL SELECT 'raw_columns', 12 + 7 + 9 + 6""")
def q_clean_tables(spark, sf_dir):
    """S11 + K3 + K9 + K10 + P20: raw tables by DDL; clean tables and a mart saved (twice: create or replace), read back
    from the catalog, and a staging view over them."""
    db = f"pv_{uuid.uuid4().hex}"
    raw = sinks.create_raw_tables(spark, db, location=scratch_path(spark, db))
    root = scratch_path(spark, f"clean-{uuid.uuid4().hex}")
    reports = sinks.stage(silver_reports_df(spark, sf_dir), f"{root}/reports")
    frames = {"clean_reports": reports, "clean_labels": sinks.stage(silver_labels_df(spark, sf_dir), f"{root}/labels"),
              "mart_adverse": marts.adverse_profile(reports)}
    for name, df in frames.items():
        for _ in range(2):
            sinks.save_table(df, f"{db}.{name}")
    sinks.register_views({f"stg_reports_{db}": read_catalog_table(spark, f"{db}.clean_reports")})
    parts = [read_catalog_table(spark, f"{db}.{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in frames]
    parts.append(spark.table(f"stg_reports_{db}").agg(F.count(F.lit(1)).alias("n")).select(F.lit("stg_reports").alias("name"), "n"))
    width = sum(len(spark.table(t).columns) for t in raw)
    parts.append(read_catalog_table(spark, raw[0]).agg((F.count(F.lit(1)) + width).alias("n")).select(F.lit("raw_columns").alias("name"), "n"))
    return reduce(DataFrame.unionByName, parts)


@register("mart_tables", _master_oracle("upper(trim(m))", "one"))
def q_mart_tables(spark, sf_dir):
    """K3 + K10: all five marts saved as tables (twice: create or replace), the master joined from the saved ones and read
    back from the catalog."""
    db = f"pv_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    clean = {"reports": silver_reports_df(spark, sf_dir), "posts": silver_posts_df(spark, sf_dir),
             "articles": silver_articles_df(spark, sf_dir), "labels": silver_labels_df(spark, sf_dir)}
    for _ in range(2):
        names = jobs.run_marts(clean, db)
    return round_doubles(read_catalog_table(spark, names["master"]).select(*MASTER_COLS))


@register("key_value_roundtrip", fixtures.oracle_ctes("posts_raw") + """
SELECT coalesce(post_id, '') AS key, post_id, subreddit, score, body, drug_mentions FROM posts_raw""")
def q_key_value_roundtrip(spark, sf_dir):
    """K7: every post published as a keyed JSON record and parsed back (lossless round trip)."""
    posts = fixtures.posts_raw(spark, sf_dir).select("post_id", "subreddit", "score", "body", "drug_mentions")
    kv = sinks.to_key_value(posts, "post_id")
    back = F.from_json("value", "post_id string, subreddit string, score int, body string, drug_mentions string")
    return kv.select("key", back.alias("r")).select("key", "r.*")
