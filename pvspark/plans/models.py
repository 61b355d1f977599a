"""Build step 9 and X1: features, labels, stable split, model metrics, attribution, risk report."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pvspark.operators import kpi, marts, model, score
from pvspark.operators.sinks import stage
from pvspark.plans import oracle_ctes as O
from pvspark.plans.base import age_group_sql, register, round_doubles
from pvspark.plans.retrieval import TFIDF_SQL
from pvspark.plans.checks import requests_df
from pvspark.plans.layers import (master_df, silver_articles_df, silver_labels_df, silver_posts_df,
                                  silver_reports_df)
from pvspark.session import scratch_path
from pvspark.sources.tables import read_table

_MASTER = O.with_layers(["reports_raw", "posts_raw", "articles_raw", "labels_raw"],
                        O.SILVER_REPORTS, O.SILVER_POSTS, O.SILVER_ARTICLES, O.SILVER_LABELS,
                        O.ADVERSE, O.sentiment(), O.RESEARCH, O.master("one"))


def _num(c: str) -> str:
    return f"round(coalesce(CAST({c} AS DOUBLE), -1.0), 6) AS {c}"


@register("features", _MASTER + "\nSELECT drug_name, "
          + age_group_sql("CAST(trunc(adv_avg_age) AS INTEGER)") + " AS age_group, "
          + ", ".join(_num(c) for c in model.CONTINUOUS) + " FROM master WHERE adv_total_reports > 0")
def q_features(spark, sf_dir):
    """M1: the 10 model features per drug."""
    return round_doubles(model.build_features(master_df(spark, sf_dir)).select(*model.FEATURES))


@register("labels_binarized", _MASTER + ",\nrate AS (SELECT drug_name, " + ", ".join(
    f"{src} / CAST(adv_total_reports AS DOUBLE) AS {t}" for t, src in model.TARGETS.items()) + " FROM master WHERE adv_total_reports > 0)"
    "\nSELECT drug_name, " + ", ".join(
    f"CASE WHEN {t} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y_{t}, "
    f"CASE WHEN {t} > (SELECT median({t}) FROM rate) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS m_{t}" for t in model.TARGETS) + " FROM rate")
def q_labels_binarized(spark, sf_dir):
    """A10 + M2: outcome rates binarised at > 0 (the reference's threshold, y_*) and above the median rate (m_*), which gives both
    classes and is what the registered models learn."""
    f = _features(spark, sf_dir)
    cut = model.medians(f)
    return f.select("drug_name", *[model.binarize(f"y_{t}").alias(f"y_{t}") for t in model.TARGETS],
                    *[model.binarize(f"y_{t}", cut[t]).alias(f"m_{t}") for t in model.TARGETS])


@register("split_stable")
def q_split_stable(spark, sf_dir):
    """M3: hash split of the drugs, stable under repartitioning (Spark-side only: xxhash64)."""
    f = model.build_features(master_df(spark, sf_dir))
    return f.groupBy(model.split_column().alias("split")).agg(F.count(F.lit(1)).alias("rows"))


def _doc_features(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    n_words, n = F.regexp_count(text, F.lit(r"\S+")).cast("double"), F.greatest(F.length(text), F.lit(1))
    share = lambda c: F.regexp_count(text, F.lit(c)) / n
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.length(text).cast("double").alias("chars"), n_words.alias("words"), share("[A-Z]").alias("capitals"),
        share("[0-9]").alias("digits"), share(r"\n").alias("lines"), share(r"[^\w\s]").alias("marks"))
    return (docs.join(read_table(spark, sf_dir, "labels"), "doc_id").withColumn("key", F.col("doc_id").cast("string"))
            .withColumns({f"y_{c}": F.col(c).cast("double") for c in ("quality", "toxic")}))


_STORED: dict = {}
_FITTED: dict = {}


def _stored(spark, sf_dir, name, make):
    """A table that several queries of a session use, written once to the shared scratch folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        df = make()
        path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        stage(df, path)
        _STORED[key] = path, df.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def _features(spark, sf_dir):
    # per-drug rows: one file, so that the many small jobs of a fit have one task each
    return _stored(spark, sf_dir, "model-features", lambda: model.build_features(_master(spark, sf_dir)).coalesce(1))


# what the marts, the KPIs and the digest read of the clean tables
_CLEAN = {
    "reports": (silver_reports_df, ["drug_name", "reaction", "age_group", "age", "is_serious", "hospitalization", "death", "disability"]),
    "posts": (silver_posts_df, ["drug_mentions", "score", "body"]),
    "articles": (silver_articles_df, ["article_id", "drug_name", "title", "abstract", "abstract_length", "publish_year"]),
    "labels": (silver_labels_df, ["drug_id", "brand_name", "warnings_length", "interactions"]),
}


def _clean(spark, sf_dir, name):
    make, cols = _CLEAN[name]
    return _stored(spark, sf_dir, f"clean-{name}", lambda: make(spark, sf_dir).select(*cols))


def _master(spark, sf_dir):
    # the facts are cleaned once for the mart and the reactions of the report; the mart reads the posts without their bodies, and the
    # clean articles if the query has written them
    def make():
        written = (spark.sparkContext.applicationId, sf_dir, "clean-articles") in _STORED
        articles = _clean(spark, sf_dir, "articles") if written else silver_articles_df(spark, sf_dir)
        return marts.build_master(_clean(spark, sf_dir, "reports"), silver_posts_df(spark, sf_dir), articles, silver_labels_df(spark, sf_dir))
    return _stored(spark, sf_dir, "master", make)


def _fitted(spark, sf_dir, targets=tuple(model.TARGETS)):
    """The outcome models (rates above the median) and their metrics, fitted once per session and data folder with the
    library's 200 trees; all model queries use the same ones (training is deterministic)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    have = _FITTED.setdefault(key, {})
    missing = [t for t in targets if t not in have]
    if missing:
        features = _features(spark, sf_dir).cache()
        cut = model.medians(features)
        have.update(model.train_all(features, {t: cut[t] for t in missing}))
        features.unpersist()
    return have


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """M4 + M5 + M10: the four outcome models on the master features; one (target, metric, value) row each (rows-only check)."""
    have = _fitted(spark, sf_dir)
    return model.metrics_frame(spark, {t: have[t][1] for t in model.TARGETS})


DOC_TREES = 40


@register("model_metrics_documents")
def q_model_metrics_documents(spark, sf_dir):
    """M4 + M5 on labelled documents: quality and toxicity from the text's measures, lang and source (rows-only check)."""
    docs = _doc_features(spark, sf_dir).cache()
    fits = model.train_all(docs, {"quality": 0.5, "toxic": 0.5}, key="key", categorical=["lang", "source"],
                           continuous=["chars", "words", "capitals", "digits", "lines", "marks"], maxIter=DOC_TREES)
    docs.unpersist()
    return model.metrics_frame(spark, {f"documents_{t}": m for t, (_, m) in fits.items()})


@register("metrics_exact", """
WITH x AS (SELECT CAST(toxic AS DOUBLE) AS y, doc_id % 53 / 52.0 AS s, lang FROM documents JOIN labels USING (doc_id)),
r AS (SELECT *, rank() OVER (PARTITION BY lang ORDER BY s) + (count(*) OVER (PARTITION BY lang, s) - 1) / 2.0 AS place FROM x),
a AS (SELECT lang, sum(y) AS pos, sum(1 - y) AS neg, sum(y * place) AS ranks, sum(CASE WHEN s >= 0.5 THEN y END) AS tp,
             sum(CASE WHEN s >= 0.5 THEN 1 - y END) AS fp,
             avg(-(y * ln(least(greatest(s, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(s, 1e-15), 1 - 1e-15)))) AS loss FROM r GROUP BY lang)
SELECT lang, round(CASE WHEN pos * neg > 0 THEN (ranks - pos * (pos + 1) / 2) / (pos * neg) ELSE 0.0 END, 6)::DOUBLE AS auc,
       round(coalesce(2 * tp / nullif(pos + tp + fp, 0), 0.0), 6)::DOUBLE AS f1, round(loss, 6)::DOUBLE AS log_loss FROM a""")
def q_metrics_exact(spark, sf_dir):
    """M5 on given scores with many ties, for each language: AUC by ranks, F1 at 0.5, log-loss."""
    x = read_table(spark, sf_dir, "documents").join(read_table(spark, sf_dir, "labels"), "doc_id").select(
        "lang", F.col("toxic").alias("label"), (F.col("doc_id") % 53 / F.lit(52.0)).alias("p1"))
    return round_doubles(model.exact_metrics(x, by=["lang"]))


def _paths(spark, sf_dir):
    feats = _features(spark, sf_dir)
    return model.path_contributions(_fitted(spark, sf_dir, ("serious",))["serious"][0], feats.withColumn("key", F.col("drug_name")), key="key")


@register("attribution_rank")
def q_attribution_rank(spark, sf_dir):
    """M7 + W4: contributions of the serious model's features to each drug's log-odds, along the trees' paths, ranked."""
    return round_doubles(_paths(spark, sf_dir).select("key", "feature", "rank", "contribution"))


@register("importance_summary")
def q_importance_summary(spark, sf_dir):
    """M9: mean absolute contribution of each feature (rows-only check)."""
    return round_doubles(model.importance(_paths(spark, sf_dir)))


def _report(spark, sf_dir):
    """The report and the written tables it is made from."""
    silver = {n: _clean(spark, sf_dir, n) for n in _CLEAN}
    have = _fitted(spark, sf_dir)
    req = requests_df(spark, sf_dir).withColumn(
        "request_id", F.concat_ws("|", "drug_name", F.col("age").cast("string"), F.col("weight").cast("string")))
    rep, _, _ = score.risk_report(req, _master(spark, sf_dir), silver["posts"], silver["articles"], silver["labels"], silver["reports"],
                                  {t: have[t][0] for t in model.TARGETS})
    return rep, req


@register("risk_report")
def q_risk_report(spark, sf_dir):
    """The 16-field report for every valid, known request in one pass (rows-only check)."""
    rep, _ = _report(spark, sf_dir)
    return rep.select(*[F.to_json(c).alias(c) if c in ("shap_values", "top_5_reactions", "known_interactions")
                        else F.col(c) for c in rep.columns])


@register("risk_summary_text")
def q_risk_summary_text(spark, sf_dir):
    """The 12-line summary text of each report row (rows-only check)."""
    return score.summary_text(_report(spark, sf_dir)[0])


@register("display_rows")
def q_display_rows(spark, sf_dir):
    """Display strings for every request - found drugs formatted, unknown drugs an
    all-N/A row (exact key rule, so mixed-case requests exercise the not-found path)."""
    rep, req = _report(spark, sf_dir)
    valid, _ = kpi.validate_requests(req)
    _, missing = kpi.lookup(valid, _master(spark, sf_dir).select("drug_name"), "exact")
    return score.display_rows(rep, missing)


@register("digest_context", _MASTER + """,
c AS (SELECT article_id AS id, coalesce(drug_name, '') AS key, abstract AS text, coalesce(title, '') AS title, coalesce(publish_year, 0) AS y
      FROM silver_articles WHERE article_id IS NOT NULL AND length(abstract) > 0),
prof AS (SELECT drug_name, 100.0 * adv_serious_reports / adv_total_reports AS pct, """ + age_group_sql("CAST(trunc(adv_avg_age) AS INTEGER)") + """ AS age_group
         FROM master WHERE adv_total_reports > 0),
q AS (SELECT drug_name AS query_id, drug_name AS want, drug_name || ' adverse effects ' || age_group || ' patients '
             || CASE WHEN pct < 30 THEN 'LOW' WHEN pct < 70 THEN 'MEDIUM' ELSE 'HIGH' END || ' risk' AS text FROM prof),""" + TFIDF_SQL + """,
ctx AS (SELECT query_id, string_agg('[' || c.id || '] ' || title || ' (' || CAST(y AS VARCHAR) || '):' || chr(10) || substr(c.text, 1, 1000),
                                    chr(10) || chr(10) ORDER BY rank) AS text FROM r JOIN c ON c.id = r.id WHERE rank <= 5 GROUP BY query_id)
SELECT drug_name AS profile_id, drug_name, coalesce(text, 'No relevant research found for ' || drug_name || '.') AS text
FROM prof LEFT JOIN ctx ON query_id = drug_name""")
def q_digest_context(spark, sf_dir):
    """Per drug profile (age group of the average age, risk label of the serious-report
    rate) the retrieved research context text (TF-IDF retrieval filtered to the drug)."""
    from pvspark.functions.rules import age_group, risk_label
    from pvspark.operators.retrieve import digest_context
    articles = _clean(spark, sf_dir, "articles")       # before the master, which reads them too
    m = _master(spark, sf_dir).filter(F.col("adv_total_reports") > 0)
    prof = m.select(F.col("drug_name").alias("profile_id"), "drug_name",
                    age_group(F.col("adv_avg_age")).alias("age_group"),
                    risk_label(F.lit(100.0) * F.col("adv_serious_reports") / F.col("adv_total_reports")).alias("risk_label"))
    return digest_context(prof, articles)
