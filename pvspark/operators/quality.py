"""Data-quality suites compiled to Spark aggregations (Q1-Q10).

A suite is a list of ``Check`` values. ``run_suite`` evaluates every row-level check in ONE
aggregation pass over the data (``count_if`` per check) plus one grouped pass per uniqueness
column (partial aggregation, so a hot value is counted map-side), and returns one result row per
check: ``(suite, check_name, column_name, total, unexpected, success)``.

Semantics follow the usual expectation library: value checks skip NULLs, uniqueness flags every
member of a duplicated group, ``mostly`` (default 1.0) is the required share of passing non-null
values. ``gate`` collects the (tiny, bounded by the number of checks) result and raises.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.functions.text import SUBREDDITS


class QualityGateError(RuntimeError):
    """Raised when a suite is unknown or any of its checks fails; the batch is not published."""


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | in_set | between | regex | length_between
    column: str
    args: tuple = field(default=())
    mostly: float = 1.0


def not_null(c): return Check("not_null", c)
def unique(c): return Check("unique", c)
def in_set(c, values): return Check("in_set", c, tuple(values))
def between(c, lo, hi, mostly=1.0): return Check("between", c, (lo, hi), mostly)
def regex(c, pattern): return Check("regex", c, (pattern,))
def length_between(c, lo, hi): return Check("length_between", c, (lo, hi))


# --- fixed values that must equal the reference's behaviour -------------------------------
SUITES: dict[str, list[Check]] = {
    "reports": [not_null("report_id"), unique("report_id"), not_null("drug_name"), not_null("severity"),
                in_set("severity", [1, 2]), between("age", 0, 120), between("weight", 0, 500),
                not_null("report_date"), regex("report_date", r"^\d{8}$")],
    "articles": [not_null("article_id"), unique("article_id"), not_null("title"), not_null("abstract"),
                 length_between("abstract", 10, 10000), not_null("publish_date"), not_null("drug_name")],
    "posts": [not_null("post_id"), unique("post_id"), not_null("body"), not_null("subreddit"),
              in_set("subreddit", SUBREDDITS), not_null("score"), between("score", -1000, 100000),
              not_null("created_utc")],
    "labels": [not_null("drug_id"), unique("drug_id"), not_null("brand_name"), not_null("generic_name"),
               not_null("warnings")],
}
# ------------------------------------------------------------------------------------------


def _unexpected(ch: Check) -> Column:
    """Per-row failure condition for a row-level check (NULL values are skipped except not_null)."""
    c = F.col(ch.column)
    if ch.kind == "not_null":
        return c.isNull()
    if ch.kind == "in_set":
        return c.isNotNull() & ~c.cast("string").isin([str(v) for v in ch.args])
    if ch.kind == "between":
        x = c.cast("string").try_cast("double")
        lo, hi = ch.args
        return c.isNotNull() & (x.isNull() | (x < lo) | (x > hi))
    if ch.kind == "regex":
        return c.isNotNull() & ~c.cast("string").rlike(ch.args[0])
    if ch.kind == "length_between":
        n = F.length(c.cast("string"))
        lo, hi = ch.args
        return c.isNotNull() & ((n < lo) | (n > hi))
    raise ValueError(ch.kind)


def _success(unexpected: Column, basis: Column, mostly: float) -> Column:
    if mostly >= 1.0:
        return unexpected == 0
    return (basis == 0) | ((basis - unexpected) / basis >= F.lit(mostly))


def run_suite(df: DataFrame, checks: list[Check], suite: str = "suite") -> DataFrame:
    row_checks = [(i, ch) for i, ch in enumerate(checks) if ch.kind != "unique"]
    parts = []
    if row_checks:
        aggs = [F.count(F.lit(1)).alias("_total")]
        for i, ch in row_checks:
            aggs.append(F.count_if(_unexpected(ch)).alias(f"u{i}"))
            aggs.append(F.count(ch.column).alias(f"n{i}"))
        one = df.agg(*aggs)
        rows = [F.struct(F.lit(i).alias("pos"), F.lit(ch.kind).alias("check_name"), F.lit(ch.column).alias("column_name"),
                         F.col("_total").alias("total"), F.col(f"u{i}").alias("unexpected"),
                         _success(F.col(f"u{i}"), F.col("_total") if ch.kind == "not_null" else F.col(f"n{i}"),
                                  ch.mostly).alias("success"))
                for i, ch in row_checks]
        parts.append(one.select(F.inline(F.array(*rows))))
    for i, ch in enumerate(checks):
        if ch.kind != "unique":
            continue
        # one grouped pass: per-value counts give both the row total and the duplicated rows
        g = df.groupBy(F.col(ch.column).alias("_v")).agg(F.count(F.lit(1)).alias("k"))
        dup_rows = F.when(F.col("_v").isNotNull() & (F.col("k") > 1), F.col("k"))
        res = g.agg(F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("total"),
                    F.coalesce(F.sum(dup_rows), F.lit(0)).cast("long").alias("unexpected"))
        parts.append(res.select(
            F.lit(i).alias("pos"), F.lit("unique").alias("check_name"), F.lit(ch.column).alias("column_name"),
            "total", "unexpected", (F.col("unexpected") == 0).alias("success")))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(suite).alias("suite"), "pos", "check_name", "column_name", "total", "unexpected", "success")


def run_named_suite(df: DataFrame, name: str) -> DataFrame:
    if name not in SUITES:
        raise QualityGateError(f"unknown suite: {name}; valid options: {', '.join(SUITES)}")
    return run_suite(df, SUITES[name], name)


def gate(results: DataFrame) -> list:
    """Q8: collect the per-check rows (bounded by the number of checks) and raise on failure."""
    rows = results.collect()
    failed = [r for r in rows if not r["success"]]
    if failed:
        desc = "; ".join(f"{r['check_name']}({r['column_name']}) unexpected={r['unexpected']}" for r in failed)
        raise QualityGateError(f"quality gate failed for {rows[0]['suite']}: {desc}")
    return rows


def mart_tests(master: DataFrame) -> DataFrame:
    """Q9: mart schema tests - drug_name not null and unique, two count columns not null."""
    return run_suite(master, [not_null("drug_name"), unique("drug_name"), not_null("adv_total_reports"),
                              not_null("sent_total_mentions")], "master")
