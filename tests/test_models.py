"""Model layer: stable split, training on a small master, save / load round trip, attribution."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY
from pvspark.operators import model


def test_split_stable_under_repartition(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("drug_name"))
    a = {r.drug_name: r.s for r in df.select("drug_name", model.split_column().alias("s")).collect()}
    b = {r.drug_name: r.s for r in df.repartition(13).select("drug_name", model.split_column().alias("s")).collect()}
    assert a == b
    share = sum(1 for v in a.values() if v == "train") / len(a)
    assert 0.75 < share < 0.85


def test_train_save_load_attribution(spark, tmp_dir):
    from pvspark.plans.layers import master_df
    feats = model.build_features(master_df(spark, SF_TINY)).cache()
    mdl, metrics, test = model.train(feats, "y_serious", threshold=model.medians(feats)["serious"], maxIter=8, minInstancesPerNode=2)
    assert set(metrics) == {"auc", "f1", "log_loss"}
    model.save_models({"serious": mdl}, tmp_dir)
    assert model.load_models(tmp_dir, ["serious", "death"]) is None          # any missing -> no result
    back = model.load_models(tmp_dir, ["serious"])["serious"]
    p1 = model.positive_probability(mdl.transform(feats)).select("drug_name", "p1").orderBy("drug_name").collect()
    p2 = model.positive_probability(back.transform(feats)).select("drug_name", "p1").orderBy("drug_name").collect()
    assert p1 == p2
    paths = model.path_contributions(mdl, feats.withColumn("key", F.col("drug_name")), key="key").groupBy("key").agg(
        (F.sum("contribution") + F.first("base")).alias("odds"), F.count(F.lit(1)).alias("n"))
    odds = model.positive_probability(mdl.transform(feats)).select("drug_name", F.log(F.col("p1") / (1 - F.col("p1"))).alias("want"))
    both = paths.join(odds, F.col("key") == F.col("drug_name")).collect()
    assert len(both) == feats.count() and all(r.n == 10 and abs(r.odds - r.want) < 1e-6 for r in both)
    c = model.contributions(mdl, feats.withColumn("key", F.col("drug_name")), model.baselines(feats), key="key")
    per_key = c.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    assert {(r.n, r.lo, r.hi) for r in per_key.collect()} == {(10, 1, 10)}
    imp = model.importance(c).collect()
    assert len(imp) == 10 and all(r.mean_abs_contribution >= 0 for r in imp)
    feats.unpersist()


def test_binarize_threshold(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (None,)], "r double")
    assert [r[0] for r in df.select(model.binarize("r", 0.1)).collect()] == [0.0, 1.0, 0.0]


def test_queries_train_the_whole_model_once(spark, monkeypatch):
    from pvspark.plans import models
    fits, train = [], model.train

    def counted(features, target, **settings):
        out = train(features, target, **settings)
        fits.append((target, out[0].stages[-1].getNumTrees))
        return out

    monkeypatch.setattr(models, "_FITTED", {})
    monkeypatch.setattr(models, "_STORED", {})
    monkeypatch.setattr(model, "train", counted)
    assert models.q_attribution_rank(spark, SF_TINY).count() > 0
    models.q_attribution_rank(spark, SF_TINY)
    assert fits == [("y_serious", 200)]


def test_exact_metrics(spark):
    """Ties, one class, nothing found, nulls, no rows."""
    import math
    import random
    rng = random.Random(3)
    cases = {"ties": [(rng.random() < 0.4, rng.choice([0.0, 0.2, 0.5, 0.9, 1.0])) for _ in range(300)],
             "spread": [(i % 3 == 0, rng.random()) for i in range(200)], "one": [(True, 0.3), (True, 0.8)], "low": [(True, 0.1), (False, 0.2)]}
    rows = [(g, int(y), s) for g, v in cases.items() for y, s in v] + [("ties", None, 0.5), ("ties", 1, None)]
    df = spark.createDataFrame(rows, "g string, label int, p1 double")
    got = {r.g: r for r in model.exact_metrics(df, by=["g"]).collect()}
    for g, v in cases.items():
        pos, neg = [s for y, s in v if y], [s for y, s in v if not y]
        auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else 0.0
        tp, fp = sum(s >= 0.5 for s in pos), sum(s >= 0.5 for s in neg)
        f1 = 2 * tp / (len(pos) + tp + fp) if len(pos) + tp + fp else 0.0
        clip = lambda s: min(max(s, 1e-15), 1 - 1e-15)
        loss = -sum(math.log(clip(s) if y else 1 - clip(s)) for y, s in v) / len(v)
        assert (got[g].auc, got[g].f1, got[g].log_loss) == (pytest.approx(auc), pytest.approx(f1), pytest.approx(loss, rel=1e-6))
    whole = model.exact_metrics(df.filter("g = 'spread'")).collect()[0]
    assert whole.auc == pytest.approx(got["spread"].auc)
    assert model.exact_metrics(df.limit(0)).collect()[0].asDict() == {"auc": 0.0, "f1": 0.0, "log_loss": 0.0}
