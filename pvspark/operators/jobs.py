"""Composite jobs: the clean-layer runner (X3) and the daily ingest job."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pvspark.operators import marts, quality, silver, sinks, validate
from pvspark.session import remove_path, scratch_path
from pvspark.sources.tables import read_catalog_table


def run_silver(raw: dict[str, DataFrame], orders: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """The four clean transforms, in order (reports, articles, posts, labels). Returns the
    clean frames; the caller writes them (``sinks.save_table``) or counts them."""
    orders = orders or {}
    return {
        "reports": silver.clean_reports(raw["reports"], orders.get("reports")),
        "articles": silver.clean_articles(raw["articles"], orders.get("articles")),
        "posts": silver.clean_posts(raw["posts"], orders.get("posts")),
        "labels": silver.clean_labels(raw["labels"], orders.get("labels")),
    }


def silver_counts(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Rows in / rows out per table: the tagged union of every input and output row, summed in
    one grouped aggregation (partial sums map-side; no joins)."""
    parts = []
    for t in raw:
        parts.append(raw[t].select(F.lit(t).alias("table"), F.lit(1).alias("i"), F.lit(0).alias("o")))
        parts.append(clean[t].select(F.lit(t).alias("table"), F.lit(0).alias("i"), F.lit(1).alias("o")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("table").agg(F.sum("i").cast("long").alias("rows_in"), F.sum("o").cast("long").alias("rows_out"))


def run_marts(clean: dict[str, DataFrame], database: str, key_mode: str = "normalized", label_pick: str = "one") -> dict[str, str]:
    """Every mart as a table of ``database`` (created or replaced), and their names by mart. The master is joined from the
    saved per-drug tables, so each fact table is read once, whoever reads the marts later."""
    spark = clean["reports"].sparkSession
    names = {m: f"{database}.mart_{m}" for m in ("adverse", "sentiment", "research", "labels", "master")}
    frames = {"adverse": marts.adverse_profile(clean["reports"]), "sentiment": marts.sentiment_profile(clean["posts"], key_mode),
              "research": marts.research_profile(clean["articles"]), "labels": marts.pick_labels(clean["labels"], label_pick)}
    for mart, df in frames.items():
        sinks.save_table(df, names[mart])
    saved = {m: read_catalog_table(spark, names[m]) for m in frames}
    sinks.save_table(marts.master_profile(saved["adverse"], saved["sentiment"], saved["research"], saved["labels"], "all"),
                     names["master"])
    return names


def _label_rules(records: DataFrame) -> list[validate.Rule]:
    """P16 on flat records; extraction leaves ``openfda_present`` if the payload may lack it."""
    present = F.col("openfda_present") if "openfda_present" in records.columns else F.lit(True)
    return validate.label_rules(F.coalesce(present, F.lit(False)))


RULES = {"reports": lambda _: validate.report_rules(), "articles": lambda _: validate.article_rules(),
         "posts": lambda _: validate.post_rules(), "labels": _label_rules}


@dataclass
class IngestResult:
    published: str
    quarantine: str
    checks: list
    counts: dict


def run_ingest(spark: SparkSession, source: str, ds: str, records: DataFrame, root: str,
               suite: str | None = None) -> IngestResult:
    """Validate -> quarantine -> stage -> quality gate -> publish.

    The batch is written once to a staging folder of its own under the shared checkpoint folder (two
    runs of a day do not meet; cutting the lineage, so the gate and the publish read materialised rows, not a recomputation); the gate
    runs on the staged valid rows and only a passing batch is published as the dated NDJSON
    batch. A failing gate raises ``QualityGateError`` and nothing is published. The counters of kept and dropped rows
    (per rule) come from the staging write itself; a failing gate's error has them as ``counts``.
    """
    stage = scratch_path(spark, f"stage/{source}/ds={ds}/{uuid.uuid4().hex}")
    rules = RULES[source](records)
    tagged = validate.tag(records, rules)
    counts = validate.write_split(tagged, stage, reasons=[r for r, _ in rules])
    # a batch without any valid row has no valid=true folder: read the parent with its schema
    whole = spark.read.schema(tagged.withColumn("valid", F.lit(True)).schema).parquet(stage)
    valid = whole.filter("valid").drop("reject_reason", "valid", "openfda_present")
    try:
        checks = quality.gate(quality.run_named_suite(valid, suite or source))
    except quality.QualityGateError as e:
        e.counts = counts
        raise
    published = sinks.write_batch(valid, root, source, ds)
    remove_path(spark, f"{stage}/valid=true")
    return IngestResult(published, f"{stage}/valid=false", checks, counts)
