"""Risk models with Spark ML.

* Features (M1): two categoricals (drug_name, age_group) + eight numerics filled with -1, from the
  master table; training derives age_group from the drug's average age, scoring from the request.
* Labels (M2): outcome rate > threshold (default 0, the reference's rule).
* Split (M3): ``pmod(xxhash64(key, seed), 100) < 80`` - stable under repartitioning and reruns,
  unlike ``randomSplit``.
* Model (M4): StringIndexer(keep) -> OneHotEncoder -> VectorAssembler -> GBTClassifier. Gradient-boosted trees
  replace the leaf-wise learner; scores are not comparable with it.
* Metrics (M5): AUC, F1 and log-loss from one table of distinct scores, by ranks with ties (``exact_metrics``).
* Attribution (M7): ``path_contributions`` follows each row through each tree; every split passed credits its feature with
  the change of the node value, so a row's contributions and the base add up to its log-odds. It is not SHAP (no
  average over feature orders). ``contributions`` is the ABLATION form - each (row, feature) copy has that feature set to its
  baseline (training mean / most frequent category) and the contribution is the drop in log-odds.
  Rows are multiplied by the fixed feature count (10), never by data size, and scored in one
  ``transform``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pvspark.functions.rules import age_group
from pvspark.operators import ranks
from pvspark.session import scratch_path

# --- fixed values that must equal the reference's behaviour -------------------------------
CATEGORICAL = ["drug_name", "age_group"]
CONTINUOUS = ["adv_avg_age", "adv_serious_reports", "adv_total_reports", "sent_total_mentions",
              "sent_avg_score", "res_total_papers", "lbl_warnings_length", "lbl_has_interactions"]
FEATURES = CATEGORICAL + CONTINUOUS
TARGETS = {"serious": "adv_serious_reports", "hospitalization": "adv_hospitalization_reports",
           "death": "adv_death_reports", "disability": "adv_disability_reports"}
# Gradient boosting settings: 200 trees, learning rate 0.05, at least 20 rows per leaf.
GBT_PARAMS = {"maxIter": 200, "stepSize": 0.05, "maxDepth": 5, "minInstancesPerNode": 20}
SPLIT_SEED = 42
TRAIN_PCT = 80
# ------------------------------------------------------------------------------------------


def _numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(f"_{c}") for c in cols]) \
        .drop(*cols).withColumnsRenamed({f"_{c}": c for c in cols})


def build_features(master: DataFrame) -> DataFrame:
    """M1 + A10: drugs with at least one report; age_group from the average age; numerics -1-filled;
    the four outcome rates as y_* columns."""
    m = master.filter(F.col("adv_total_reports") > 0)
    tot = F.col("adv_total_reports").cast("double")
    ys = [F.try_divide(F.col(src).cast("double"), tot).alias(f"y_{t}") for t, src in TARGETS.items()]
    base = m.select("drug_name", age_group(F.col("adv_avg_age")).alias("age_group"),
                    *[F.col(c) for c in CONTINUOUS], *ys)
    return _numeric(base, CONTINUOUS)


def binarize(c, threshold: float = 0.0):
    """M2: 1.0 when the rate is above the threshold, else 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def split_column(key: str = "drug_name", seed: int = SPLIT_SEED, train_pct: int = TRAIN_PCT):
    """M3: deterministic train / test assignment from a hash of the key."""
    return F.when(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100)) < train_pct, F.lit("train")) \
        .otherwise(F.lit("test"))


def pipeline(categorical: Sequence[str] = CATEGORICAL, continuous: Sequence[str] = CONTINUOUS,
             label: str = "label", max_bins: int = 128, **gbt) -> Pipeline:
    params = dict(GBT_PARAMS)
    params.update(gbt)
    # categoricals: index (unseen -> extra bucket) then one-hot, so a drug vocabulary of any size
    # becomes sparse 0/1 columns instead of a categorical split bounded by maxBins
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical],
                        dropLast=False, handleInvalid="keep")
    vec = VectorAssembler(inputCols=[f"{c}_ohe" for c in categorical] + list(continuous), outputCol="features",
                          handleInvalid="keep")
    clf = GBTClassifier(featuresCol="features", labelCol=label, maxBins=max_bins, seed=SPLIT_SEED, **params)
    return Pipeline(stages=idx + [ohe, vec, clf])


def positive_probability(pred: DataFrame, out: str = "p1") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


def exact_metrics(scored: DataFrame, label: str = "label", score: str = "p1", by: Sequence[str] = (), folder: str | None = None) -> DataFrame:
    """M5: one row (auc, f1, log_loss) over rows with a 0 / 1 label and a score from 0 to 1; with ``by``, one for each group.

    Rows combine map-side into distinct scores; those go to range partitions, and each score's rank follows from its
    partition's prefix sum. AUC counts ties as one half and is 0 if a class is missing; F1 is that of scores from 0.5 on, 0 if
    there is nothing to find; log-loss clips scores by 1e-15 and is 0 without rows. Null labels or scores are left out.
    """
    y, s = F.col(label).cast("double"), F.col(score).cast("double")
    per = (scored.filter(y.isNotNull() & s.isNotNull()).groupBy(*by, s.alias("s"))
           .agg(F.count_if(y == 1.0).alias("pos"), F.count_if(y != 1.0).alias("neg")))
    by = list(by)
    ranged = ranks.range_parts(per, [*[F.col(c) for c in by], F.col("s")], folder)
    before = ranks.part_offsets(ranged, by, F.col("neg"), "all_neg", "part_neg")
    before = before.select(F.col("__part").alias("p"), *[F.col(c).alias(f"__{c}") for c in by], "part_neg")
    inside = F.sum("neg").over(Window.partitionBy("__part", *by).orderBy("s")) - F.col("neg")
    on = F.col("__part") == F.col("p")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    below = ranged.withColumn("inside", inside).join(before, on)
    p = F.least(F.greatest(F.col("s"), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p))
    hit = F.col("s") >= 0.5
    a = below.groupBy(*by).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                  F.sum(F.col("pos") * (F.col("part_neg") + F.col("inside") + F.col("neg") / 2)).alias("won"),
                  F.sum(F.when(hit, F.col("pos"))).alias("tp"), F.sum(F.when(hit, F.col("neg"))).alias("fp"), F.sum(loss).alias("loss"))
    zero = F.lit(0.0)
    tp, fp = F.coalesce("tp", F.lit(0)), F.coalesce("fp", F.lit(0))
    return a.select(*by, F.coalesce(F.try_divide(F.col("won"), F.col("pos") * F.col("neg")), zero).alias("auc"),
                    F.coalesce(F.try_divide(2.0 * tp, F.col("pos") + tp + fp), zero).alias("f1"),
                    F.coalesce(F.try_divide(F.col("loss"), F.col("pos") + F.col("neg")), zero).alias("log_loss"))


def evaluate(pred: DataFrame, label: str = "label") -> dict:
    """M5 of a model's predictions as a dict."""
    return exact_metrics(positive_probability(pred), label).collect()[0].asDict()


def medians(features: DataFrame, targets: Sequence[str] = tuple(TARGETS)) -> dict[str, float]:
    """The median rate of each target over the (per-drug) features: a threshold with both classes."""
    return features.agg(*[F.median(f"y_{t}").alias(t) for t in targets]).collect()[0].asDict()


def train(features: DataFrame, target: str, threshold: float = 0.0, key: str = "drug_name",
          categorical=CATEGORICAL, continuous=CONTINUOUS, **gbt) -> tuple[PipelineModel, dict, DataFrame]:
    """M2-M5 for one target column (a rate): binarise, split by key hash, fit, evaluate on test."""
    data = features.withColumn("label", binarize(target, threshold)).withColumn("_split", split_column(key))
    tr, te = data.filter("_split = 'train'"), data.filter("_split = 'test'")
    model = pipeline(categorical, continuous, **gbt).fit(tr)
    pred = model.transform(te)
    return model, evaluate(pred), te


def train_all(features: DataFrame, thresholds: dict[str, float], parallel: int = 4, **settings) -> dict[str, tuple[PipelineModel, dict]]:
    """M4: one model and its metrics per target; the fits are independent jobs, ``parallel`` of them at a time."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(parallel) as pool:
        fits = {t: pool.submit(train, features, f"y_{t}", threshold=x, **settings) for t, x in thresholds.items()}
        return {t: f.result()[:2] for t, f in fits.items()}


def metrics_frame(spark, results: dict) -> DataFrame:
    """(target, metric, value) rows for a run."""
    rows = [(t, m, float(v)) for t, d in results.items() for m, v in d.items()]
    return spark.createDataFrame(rows, "target string, metric string, value double")


def save_models(models: dict, path: str) -> None:
    """M8: persist every model under ``path/<target>``."""
    for name, m in models.items():
        m.write().overwrite().save(f"{path.rstrip('/')}/{name}")


def load_models(path: str, names: Sequence[str] = tuple(TARGETS)) -> dict | None:
    """M8: load all models; None when any is missing (no partial scoring)."""
    out = {}
    for n in names:
        try:
            out[n] = PipelineModel.load(f"{path.rstrip('/')}/{n}")
        except Exception:  # noqa: BLE001 - a missing model means "no result", as in the reference
            return None
    return out


def baselines(train_df: DataFrame, categorical=CATEGORICAL, continuous=CONTINUOUS) -> DataFrame:
    """One-row baseline: mean of each numeric, most frequent value of each categorical (of equally frequent ones
    the smallest, so the result does not depend on the partitioning)."""
    aggs = [F.avg(c).alias(c) for c in continuous]
    aggs += [F.mode(c, True).alias(c) for c in categorical]
    return train_df.agg(*aggs)


def contributions(model: PipelineModel, rows: DataFrame, baseline: DataFrame, key: str = "row_id",
                  categorical=CATEGORICAL, continuous=CONTINUOUS) -> DataFrame:
    """Ablation attribution. One row per (key, feature): contribution = logit(p) -
    logit(p with that feature at baseline), ranked by |contribution| desc then feature name."""
    feats = list(categorical) + list(continuous)
    b = baseline.select(F.struct(*feats).alias("b")).scalar()       # one subquery for all features
    base = {c: b[c] for c in feats}
    ablate = rows.select("*", F.explode(F.array(F.lit("__none__"), *[F.lit(f) for f in feats])).alias("_ablated"))
    for c in feats:
        ablate = ablate.withColumn(c, F.when(F.col("_ablated") == c, base[c].cast(rows.schema[c].dataType))
                                   .otherwise(F.col(c)))
    p = positive_probability(model.transform(ablate)).select(key, "_ablated", "p1")
    eps = 1e-12
    logit = F.log((F.col("p1") + eps) / (F.lit(1.0) - F.col("p1") + eps))
    # the unablated log-odds of the same key, via a window over the key (one shuffle, no self-join);
    # the ranking window below reuses the same partitioning
    by_key = Window.partitionBy(key)
    p = p.withColumn("logit", logit).withColumn(
        "_full", F.max(F.when(F.col("_ablated") == "__none__", F.col("logit"))).over(by_key))
    contrib = p.filter(F.col("_ablated") != "__none__").select(
        key, F.col("_ablated").alias("feature"), (F.col("_full") - F.col("logit")).alias("contribution"))
    w = Window.partitionBy(key).orderBy(F.abs("contribution").desc(), F.col("feature"))
    return contrib.withColumn("rank", F.row_number().over(w))


def ensemble_nodes(model: PipelineModel, folder: str, categorical=CATEGORICAL, continuous=CONTINUOUS) -> tuple[DataFrame, float, int]:
    """The split nodes of a fitted ensemble as a table, the log-odds that all roots give, and the depth of the trees.

    A row is (tree, node, feature, where the feature's value is, the split, and for both sides the child and the change of
    log-odds). Read from the saved form; its size is bounded by the training settings (trees x nodes), not by data.
    """
    gbt, spark = model.stages[-1], SparkSession.active()
    gbt.write().overwrite().save(folder)
    n = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("prediction").alias("value"), "leftChild", "rightChild",
        F.col("split.featureIndex").alias("at"), F.col("split.leftCategoriesOrThreshold").alias("left_if"),
        (F.col("split.numCategories") == -1).alias("ordered"))
    weights = spark.createDataFrame(list(enumerate(map(float, gbt.treeWeights))), "tree int, weight double")
    n = n.join(F.broadcast(weights), "tree")                       # one row a tree
    base = n.filter("node = 0").agg(F.sum(2.0 * F.col("weight") * F.col("value")).alias("b")).collect()[0].b
    labels = [st.labels for st in model.stages if hasattr(st, "labels")]
    # the encoder keeps a place for invalid values after each column's categories
    sizes = [n + 1 for st in model.stages if hasattr(st, "categorySizes") for n in st.categorySizes]
    used = [r["at"] for r in n.filter("leftChild >= 0").select("at").distinct().collect()]      # at most the number of nodes
    rows = []
    for at in used:
        start = 0
        for c, known, size in zip(categorical, labels, sizes, strict=True):
            if start <= at < start + size:
                rows.append((at, c, categorical.index(c), known[at - start] if at - start < len(known) else None, None))
            start += size
        if at >= start:
            rows.append((at, continuous[at - start], None, None, at - start))
    where = spark.createDataFrame(rows, "at int, feature string, cat int, category string, num int")
    child = n.select("tree", F.col("node").alias("child"), F.col("value").alias("child_value"))
    split = n.filter("leftChild >= 0").join(F.broadcast(where), "at")
    for side in ("left", "right"):
        split = (split.join(child.withColumnRenamed("child", f"{side}Child"), ["tree", f"{side}Child"])
                 .withColumn(f"{side}_gain", 2.0 * F.col("weight") * (F.col("child_value") - F.col("value"))).drop("child_value"))
    return (split.select("tree", "node", "feature", "cat", "category", "num", "left_if", "ordered", F.col("leftChild").alias("left"),
                         F.col("rightChild").alias("right"), "left_gain", "right_gain"), base, gbt.getMaxDepth())


def path_contributions(model: PipelineModel, rows: DataFrame, key: str = "row_id", categorical=CATEGORICAL, continuous=CONTINUOUS,
                       folder: str | None = None) -> DataFrame:
    """Key, feature, contribution (log-odds), rank by |contribution| desc then feature, and base: per key,
    base + the sum of contributions = log(p / (1 - p)). Keys must be unique.

    Each row walks down all trees at once, a level a join with the node table, and its steps are summed in its own
    task before the one shuffle.
    """
    spark = rows.sparkSession
    folder = folder or scratch_path(spark, f"ensemble-{uuid.uuid4().hex}")
    nodes, base, depth = ensemble_nodes(model, folder, list(categorical), list(continuous))
    nodes.write.parquet(f"{folder}-nodes")
    nodes = F.broadcast(spark.read.schema(nodes.schema).parquet(f"{folder}-nodes"))             # bounded by the settings
    trees = model.stages[-1].getNumTrees
    walk = rows.select(F.col(key).alias("key"), F.array(*[F.col(c) for c in categorical]).alias("cats"),
                       F.array(*[F.col(c).cast("double") for c in continuous]).alias("nums"),
                       F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumns(
        {"node": F.lit(0), "steps": F.array().cast("array<struct<feature:string,gain:double>>")})
    x = F.when(F.col("cat").isNull(), F.get("nums", F.col("num"))).otherwise(
        F.when(F.get("cats", F.col("cat")).eqNullSafe(F.col("category")), 1.0).otherwise(0.0))
    left = F.when(F.col("ordered"), x <= F.get("left_if", F.lit(0))).otherwise(F.array_contains("left_if", x))
    for _ in range(depth):
        walk = walk.join(nodes, ["tree", "node"], "left").select(
            "key", "cats", "nums", "tree", F.when(left, F.col("left")).otherwise(F.col("right")).alias("node"),
            F.when(F.col("feature").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(F.struct(
                "feature", F.when(left, F.col("left_gain")).otherwise(F.col("right_gain")).alias("gain"))))).alias("steps"))
    steps = walk.select("key", F.explode("steps").alias("s")).select("key", "s.feature", "s.gain")
    none = rows.select(F.col(key).alias("key"), F.explode(F.array(*[F.lit(c) for c in [*categorical, *continuous]])).alias("feature"),
                       F.lit(0.0).alias("gain"))
    total = steps.unionByName(none).groupBy("key", "feature").agg(F.sum("gain").alias("contribution"))
    # the order of additions must not decide between features of equal weight
    w = Window.partitionBy("key").orderBy(F.round(F.abs("contribution"), 9).desc(), "feature")
    return total.select(F.col("key").alias(key), "feature", "contribution", F.row_number().over(w).alias("rank"), F.lit(base).alias("base"))


def importance(contrib: DataFrame) -> DataFrame:
    """M9: mean absolute contribution per feature (the summary-plot table)."""
    return contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))


def scoring_rows(requests: DataFrame, master: DataFrame) -> DataFrame:
    """Request ⋈ master features; age_group from the REQUEST's age; numerics -1-filled."""
    m = master.select("drug_name", *CONTINUOUS)
    j = requests.join(m.withColumnRenamed("drug_name", "lookup_key"), "lookup_key", "inner")
    j = j.withColumn("age_group", age_group(F.col("age")))
    return _numeric(j, CONTINUOUS)
