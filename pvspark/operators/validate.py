"""Record validity rules with quarantine.

A rule set is an ordered list of ``(reason, failing_condition)``; the FIRST failing rule names the
reason, as in the reference's early-``continue`` filters. ``split_valid`` tags each row once and
returns views of the same tagged frame, so a writer can emit valid rows and the quarantine in one
pass (``write_split``) instead of scanning the input twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pvspark.functions.rules import VALID_SEVERITIES, blank

Rule = tuple[str, Column]


def _falsy(c: str) -> Column:
    return blank(F.col(c))


def report_rules() -> list[Rule]:
    """Id and drug name truthy, severity 1 or 2 (as int or string)."""
    sev = F.col("severity").cast("string")
    return [("missing report_id", _falsy("report_id")),
            ("missing drug_name", _falsy("drug_name")),
            ("invalid severity", sev.isNull() | ~sev.isin([str(s) for s in VALID_SEVERITIES]))]


def label_rules(openfda_present: Column) -> list[Rule]:
    """Id truthy, ``openfda`` present and not null."""
    return [("missing id", _falsy("drug_id")), ("missing openfda", ~openfda_present)]


def article_rules() -> list[Rule]:
    """Id, title, abstract non-empty."""
    return [("missing article_id", _falsy("article_id")), ("missing title", _falsy("title")),
            ("missing abstract", _falsy("abstract"))]


def post_rules() -> list[Rule]:
    """The stream consumer's reasons, verbatim."""
    return [("post_id is null", _falsy("post_id")),
            ("body is null or empty", _falsy("body")),
            ("created_utc is null", F.col("created_utc").isNull())]


def request_rules() -> list[Rule]:
    """Scoring requests: age 0-120, 0 < weight <= 500."""
    age, w = F.col("age"), F.col("weight")
    return [("missing drug_name", _falsy("drug_name")),
            ("age out of range", age.isNull() | (age < 0) | (age > 120)),
            ("weight out of range", w.isNull() | (w <= 0) | (w > 500))]


def reason(rules: Sequence[Rule]) -> Column:
    """First failing rule's reason, NULL when the row is valid (a NULL condition counts as pass)."""
    return F.coalesce(*[F.when(cond, F.lit(r)) for r, cond in rules]) if rules else F.lit(None).cast("string")


def tag(df: DataFrame, rules: Sequence[Rule], col: str = "reject_reason") -> DataFrame:
    return df.withColumn(col, reason(rules))


def split_valid(df: DataFrame, rules: Sequence[Rule], col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, rejected rows with it)."""
    t = tag(df, rules, col)
    return t.filter(F.col(col).isNull()).drop(col), t.filter(F.col(col).isNotNull())


def reject_counts(tagged: DataFrame, source: str, col: str = "reject_reason") -> DataFrame:
    """Kept / dropped counters as a (source, reason, n) frame; kept rows count as ``kept``."""
    return (tagged.groupBy(F.coalesce(F.col(col), F.lit("kept")).alias("reason")).count()
            .select(F.lit(source).alias("source"), "reason", F.col("count").alias("n")))


def write_split(tagged: DataFrame, path: str, col: str = "reject_reason", fmt: str = "parquet",
                mode: str = "overwrite", reasons: Sequence[str] = ()) -> dict[str, int]:
    """K11 + A11: one pass writes ``valid=true`` rows and the ``valid=false`` quarantine (with reason) and counts them: ``kept``,
    ``dropped``, and each of ``reasons``. The counts are observed on the rows as they are written; nothing is read twice."""
    seen = Observation()
    counts = [F.count_if(F.col(col).isNull()).alias("kept"), F.count_if(F.col(col).isNotNull()).alias("dropped"),
              *[F.count_if(F.col(col) == r).alias(f"r{i}") for i, r in enumerate(reasons)]]
    (tagged.observe(seen, *counts).withColumn("valid", F.col(col).isNull())
     .write.mode(mode).partitionBy("valid").format(fmt).save(path))
    got = seen.get
    return {"kept": got["kept"], "dropped": got["dropped"]} | {r: got[f"r{i}"] for i, r in enumerate(reasons)}
