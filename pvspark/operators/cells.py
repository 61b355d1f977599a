"""kNN over k-means cells, exact by the triangle inequality or approximate by a number of probes.

``build`` fits centres on a bounded sample (``SAMPLE`` rows, the smallest hashes), assigns every vector to its nearest centre,
and writes the vectors partitioned by cell, with a table of each cell's size and radius (per filter key). A vector of a
cell is at least (distance to the centre - radius) away from a query, so ``search`` looks at a query's nearest cells
until they hold k vectors, takes the k-th distance found as bound, and then reads only the cells whose least distance is
within it. With ``probes`` the nearest cells are all that is read.

A (query, cell) row is all that leaves the centres: at most ``cells`` rows a query, and ``cells`` is a parameter
of the index. Cells of any size are dealt out in parts. Distances are squared L2; ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pvspark.operators.retrieve import PART, part_search

SAMPLE = 50_000
CELLS = 64


@dataclass(frozen=True)
class Cells:
    path: str                   # vectors: vec_id, v, key, cell (partition folder)
    schema: str
    stats: DataFrame            # key, cell, n, radius
    centres: np.ndarray


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact differences in blocks, since a product of matrices loses the digits that a bound needs."""
    return np.sqrt(np.stack([((points - c) ** 2).sum(axis=1) for c in centres], axis=1))


def build(corpus: DataFrame, path: str, cells: int = CELLS, id_col: str = "vec_id", vec_col: str = "embedding", key_col: str | None = None,
          sample: int = SAMPLE, seed: int = 7) -> Cells:
    """Write ``corpus`` as cells under ``path``. NULL vectors are left out: they match nothing."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = corpus.sparkSession
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    rows = corpus.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"), key.alias("key")).filter("v is not null")
    some = (rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
            .select(array_to_vector(F.col("v").cast("array<double>")).alias("x")))
    if rows.isEmpty():
        centres = np.zeros((0, 0))
    else:
        fitted = KMeans(k=cells, seed=seed, featuresCol="x", maxIter=10).fit(some)
        centres = np.array(fitted.clusterCenters())

    def assign(frames):
        for f in frames:
            if len(f):
                d = _distances(np.stack(f["v"].to_numpy()).astype(np.float64), centres)
                f["cell"] = d.argmin(axis=1).astype(np.int32)
                f["away"] = d.min(axis=1)
                yield f

    kinds = dict(rows.dtypes)
    schema = f"vec_id {kinds['vec_id']}, v {kinds['v']}, key string, cell int, away double"
    rows.mapInPandas(assign, schema).write.option("compression", "zstd").partitionBy("cell").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    stats = table.groupBy("key", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
    stats.write.parquet(f"{path.rstrip('/')}-stats")
    return Cells(path, schema, spark.read.schema(stats.schema).parquet(f"{path.rstrip('/')}-stats"), centres)


def _reach(queries: DataFrame, cells: Cells, filtered: bool) -> DataFrame:
    """query_id, q, key, cell, n, away (distance to the centre), least (possible distance of a vector in the cell)."""
    centres = cells.centres

    def measure(frames):
        for f in frames:
            if len(f) and len(centres):
                d = _distances(np.stack(f["q"].to_numpy()).astype(np.float64), centres)
                yield pd.DataFrame({"query_id": np.repeat(f["query_id"].to_numpy(), len(centres)), "want": np.repeat(f["want"].to_numpy(), len(centres)),
                                    "cell": np.tile(np.arange(len(centres), dtype=np.int32), len(f)), "away": d.ravel()})

    kinds = dict(queries.dtypes)
    near = queries.mapInPandas(measure, f"query_id {kinds['query_id']}, want string, cell int, away double")
    stats = cells.stats.withColumnRenamed("cell", "c")
    if filtered:
        some = near.filter("want is not null").join(stats, (F.col("cell") == F.col("c")) & (F.col("want") == F.col("key"))).drop("c")
        every = near.filter("want is null").join(stats, F.col("cell") == F.col("c")).drop("c")
        near = some.unionByName(every)
    else:
        near = near.join(stats, F.col("cell") == F.col("c")).drop("c")
    # rounding of the two distances must not skip a cell
    slack = 1e-9 * (F.col("away") + F.col("radius") + 1)
    return near.withColumn("least", F.greatest(F.lit(0.0), F.col("away") - F.col("radius") - slack))


def _look(pairs: DataFrame, queries: DataFrame, cells: Cells, k: int, part: int) -> DataFrame:
    """query_id, vec_id, distance: the k nearest vectors of each (query_id, key, cell, n) pair."""
    table = queries.sparkSession.read.schema(cells.schema).parquet(cells.path)
    parts = pairs.groupBy("key", "cell").agg(F.ceil(F.max("n") / part).cast("int").alias("parts"))
    wanted = parts.select(F.col("key").alias("k_"), F.col("cell").alias("c_"), "parts")
    # only the folders of wanted cells are read
    dealt = (table.join(wanted, (F.col("cell") == F.col("c_")) & F.col("key").eqNullSafe(F.col("k_")))
             .select("vec_id", "v", "key", "cell", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part")))
    sent = (pairs.select("query_id", "key", "cell").join(wanted, (F.col("cell") == F.col("c_")) & F.col("key").eqNullSafe(F.col("k_")))
            .select("query_id", "key", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
            .join(queries.select("query_id", "q"), "query_id"))
    # null keys meet as empty text beside a mark
    mark = [F.coalesce("key", F.lit("")).alias("key"), F.col("key").isNull().alias("nokey"), "cell", "part"]
    kinds = dict(queries.dtypes) | dict(table.dtypes)
    by = ["key", "nokey", "cell", "part"]
    return (dealt.select("vec_id", "v", *mark).groupBy(*by).cogroup(sent.select("query_id", "q", *mark).groupBy(*by))
            .applyInPandas(part_search(k), f"query_id {kinds['query_id']}, vec_id {kinds['vec_id']}, distance double"))


def search(cells: Cells, queries: DataFrame, k: int = 5, query_id_col: str = "query_id", vec_col: str = "embedding", query_key_col: str | None = None,
           probes: int | None = None, part: int = PART, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits, read): query_id, rank, vec_id, distance of the k nearest vectors; and the (query_id, key, cell) that were looked at.

    Exact, or limited to each query's ``probes`` nearest cells. A NULL query key searches all keys.
    """
    import uuid

    from pvspark.session import scratch_path

    spark = queries.sparkSession
    folder = folder or scratch_path(spark, f"cells-{uuid.uuid4().hex}")
    want = F.col(query_key_col).cast("string") if query_key_col else F.lit(None).cast("string")
    asked = (queries.select(F.col(query_id_col).alias("query_id"), F.col(vec_col).alias("q"), want.alias("want"))
             .filter("q is not null").dropDuplicates(["query_id"]))

    def stored(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    reach = _reach(asked, cells, bool(query_key_col))
    by = Window.partitionBy("query_id").orderBy("away", "cell", "key")
    reach = stored(reach.withColumns({"place": F.row_number().over(by),
                                      "before": F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}), "reach")
    first = reach.filter(F.col("place") <= probes) if probes else reach.filter(F.col("before") < k)
    found = stored(_look(first, asked, cells, k, part), "first")
    read = first.select("query_id", "key", "cell")
    if probes is None:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance"))
        bound = found.withColumn("place", place).filter(F.col("place") == k).select("query_id", F.sqrt("distance").alias("bound"))
        rest = (reach.filter(F.col("before") >= k).join(bound, "query_id", "left")
                .filter(F.col("bound").isNull() | (F.col("least") <= F.col("bound"))))
        rest = stored(rest.drop("bound"), "rest")
        found = found.unionByName(_look(rest, asked, cells, k, part))
        read = read.unionByName(rest.select("query_id", "key", "cell"))
    w = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    hits = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "distance")
    return hits, read
