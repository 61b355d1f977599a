"""Adapters: the driver's TPC-H-ish tables mapped onto the four raw record shapes.

Each adapter is ONE SQL text valid in both Spark SQL and DuckDB, so the Spark query and its
oracle start from identical rows. Placeholders ``{lineitem}`` etc. are filled with DataFrames on
the Spark side (``spark.sql(text, lineitem=df)``) and with view names on the DuckDB side.
The "dirt" (nulls, blanks, bad dates, duplicate ids) is injected by fixed modulo rules so every
cleaning rule has rows to act on; the adapters keep every input row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from pvspark.sources.tables import read_table

# Flat report records (lineitem x part). report_id repeats; tie1..tie4 give a total order.
REPORTS_RAW = """
SELECT
  concat(cast(l.l_orderkey AS string), '-', cast(l.l_linenumber AS string)) AS report_id,
  CASE WHEN l.l_orderkey % 97 = 0 THEN NULL
       WHEN l.l_orderkey % 89 = 0 THEN '   '
       ELSE concat(' ', p.p_name, ' ') END AS drug_name,
  CASE WHEN l.l_suppkey % 53 = 0 THEN NULL ELSE p.p_brand END AS reaction,
  CASE WHEN l.l_orderkey % 103 = 0 THEN 'x'
       WHEN l.l_returnflag = 'R' THEN '1'
       WHEN l.l_returnflag = 'A' THEN '2'
       WHEN l.l_linestatus = 'F' THEN '1'
       ELSE '3' END AS severity,
  CASE WHEN l.l_orderkey % 11 = 0 THEN NULL
       WHEN l.l_orderkey % 13 = 0 THEN '45.0'
       WHEN l.l_orderkey % 101 = 0 THEN '130'
       ELSE cast(cast(l.l_quantity * 2 AS int) AS string) END AS age,
  cast(l.l_extendedprice / 250 AS string) AS weight,
  CASE WHEN l.l_orderkey % 107 = 0 THEN '20241341'
       ELSE replace(substr(cast(l.l_shipdate AS string), 1, 10), '-', '') END AS report_date,
  CASE WHEN l.l_linestatus = 'F' THEN '1' END AS hospitalization,
  CASE WHEN l.l_discount >= 0.09 THEN '1' ELSE '0' END AS death,
  CASE WHEN l.l_tax >= 0.07 THEN '1' ELSE 'n/a' END AS disability,
  l.l_shipdate AS ingestion_ts,
  l.l_partkey AS tie1, l.l_suppkey AS tie2, l.l_quantity AS tie3, l.l_extendedprice AS tie4
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# Forum posts (events x part x part). drug_mentions is added by the keyword tagger.
POSTS_RAW = """
SELECT
  cast(e.event_id - e.event_id % 3 % 2 AS string) AS post_id,
  e.event_type AS subreddit,
  a.p_name AS title,
  CASE WHEN e.event_id % 41 = 0 THEN ''
       ELSE concat(e.event_type, ' after ', b.p_name, ' ', e.props) END AS body,
  cast(floor(e.value) AS int) AS score,
  e.ts AS created_utc,
  e.event_id AS tie1
FROM {events} e
JOIN {part} a ON a.p_partkey = e.event_id % (SELECT count(*) FROM {part})
JOIN {part} b ON b.p_partkey = (e.event_id * 7) % (SELECT count(*) FROM {part})
"""

# Research articles (documents x part).
ARTICLES_RAW = """
SELECT
  cast(d.doc_id AS string) AS article_id,
  split_part(d.text, chr(10), 1) AS title,
  CASE WHEN d.doc_id % 5 = 0 THEN concat(d.text, ' Adverse events') ELSE d.text END AS abstract,
  concat(cast(1990 + d.doc_id % 35 AS string), '-',
         CASE WHEN d.doc_id % 29 = 0 THEN '13'
              ELSE lpad(cast(1 + d.doc_id % 12 AS string), 2, '0') END,
         '-01') AS publish_date,
  CASE WHEN d.doc_id % 7 = 0 THEN 'unknown' ELSE p.p_name END AS drug_name
FROM {documents} d JOIN {part} p ON p.p_partkey = d.doc_id % (SELECT count(*) FROM {part})
"""

# Drug labels (part). brand_name is not unique, so the label join fans out (F2).
LABELS_RAW = """
SELECT
  cast(p_partkey AS string) AS drug_id,
  CASE WHEN p_partkey % 5 = 0 THEN 'unknown' ELSE p_name END AS brand_name,
  CASE WHEN p_partkey % 10 = 0 THEN 'unknown' ELSE p_type END AS generic_name,
  CASE WHEN p_partkey % 31 = 0 THEN NULL
       ELSE repeat(concat(p_name, ' '), CASE WHEN p_partkey % 4 = 0 THEN p_size * 5 ELSE p_size END) END AS warnings,
  CASE WHEN p_partkey % 3 = 0 THEN NULL
       WHEN p_partkey % 4 = 0 THEN 'none'
       ELSE concat(p_brand, ', ', p_type, ' ,,') END AS interactions
FROM {part}
"""

ADAPTERS = {
    "reports_raw": REPORTS_RAW,
    "posts_base": POSTS_RAW,
    "articles_raw": ARTICLES_RAW,
    "labels_raw": LABELS_RAW,
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def _spark_adapter(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = set(_PLACEHOLDER.findall(text))
    return spark.sql(text, **{n: read_table(spark, sf_dir, n) for n in names})


def duckdb_adapter(name: str) -> str:
    """The adapter text with placeholders replaced by the driver's view names."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), ADAPTERS[name])


def reports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_adapter(spark, sf_dir, REPORTS_RAW)


def posts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_adapter(spark, sf_dir, POSTS_RAW)


def articles_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_adapter(spark, sf_dir, ARTICLES_RAW)


def labels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_adapter(spark, sf_dir, LABELS_RAW)


def drug_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary for the fixture tagger: distinct part names (a bounded vocabulary)."""
    return read_table(spark, sf_dir, "part").select("p_name").distinct().withColumnRenamed("p_name", "term")


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with ``drug_mentions`` filled by the all-matches tagger over title + body."""
    from pyspark.sql import functions as F

    from pvspark.functions.text import tag_dictionary

    hay = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    return tag_dictionary(posts_base(spark, sf_dir), hay, drug_dictionary(spark, sf_dir))


# DuckDB twin of posts_raw: same adapter plus the tagger written with list_filter.
POSTS_RAW_DUCKDB_TAGGER = """
posts_raw AS (
  SELECT b.*,
    CASE WHEN len(list_filter(t.terms, lambda k: contains(lower(concat(coalesce(b.title, ''), ' ', coalesce(b.body, ''))), lower(k)))) = 0
         THEN 'unknown'
         ELSE array_to_string(list_filter(t.terms, lambda k: contains(lower(concat(coalesce(b.title, ''), ' ', coalesce(b.body, ''))), lower(k))), ',')
    END AS drug_mentions
  FROM posts_base b, (SELECT list(p_name ORDER BY p_name) AS terms FROM (SELECT DISTINCT p_name FROM part)) t
)"""


def oracle_ctes(*names: str) -> str:
    """``WITH`` prefix defining the requested adapters for a DuckDB oracle query."""
    parts = []
    need = list(names)
    if "posts_raw" in need and "posts_base" not in need:
        need.insert(need.index("posts_raw"), "posts_base")
    for n in need:
        if n == "posts_raw":
            parts.append(POSTS_RAW_DUCKDB_TAGGER.strip())
        else:
            parts.append(f"{n} AS ({duckdb_adapter(n).strip()})")
    return "WITH " + ",\n".join(parts)
