"""Ranks over tables of any size: range partitions, counts per partition, prefix sums.

A window without ``partitionBy`` sorts the whole table in one task. Here rows go to range partitions of the order,
which are written once (so that both passes see the same ones); every partition numbers its rows, and the number of
rows in the partitions before it is added. The prefix sums run over one row per (group, partition).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pvspark.session import scratch_path


def range_parts(df: DataFrame, order: list[Column], path: str | None = None) -> DataFrame:
    """``df`` and ``__part``: the number of the range partition of ``order`` that holds the row; written to ``path``
    (a new folder of the shared scratch folder unless given)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"ranks-{uuid.uuid4().hex}")
    out = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    out.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def part_offsets(ranged: DataFrame, groups: list[str], value: Column, total: str, before: str) -> DataFrame:
    """(*groups, __part, ``before``, ``total``): the sum of ``value`` in the group's earlier partitions, and in all."""
    sums = ranged.groupBy(*groups, "__part").agg(F.sum(value).alias("__v"))
    by = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    return sums.select(*groups, "__part",
                       F.coalesce(F.sum("__v").over(by.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(before),
                       F.sum("__v").over(by).alias(total))


def numbered(df: DataFrame, order: list[Column], groups: list[str] = (), name: str = "rank", total: str | None = None,
             path: str | None = None) -> DataFrame:
    """``df`` with its place from 0 in ``order`` (inside ``groups``, which may be null and whose rows may be a large
    part of all) as ``name``; ``total``: rows of the group. Equal rows get different places in any order."""
    groups = list(groups)
    ranged = range_parts(df, [*[F.col(g) for g in groups], *order], path)
    offsets = part_offsets(ranged, groups, F.lit(1), "__total", "__before")
    keys = [*groups, "__part"]
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    right = offsets.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__before", "__total")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = ranged.withColumn("__at", place).join(right, same)
    return out.select(*df.columns, (F.col("__before") + F.col("__at") - 1).alias(name),
                      *([F.col("__total").alias(total)] if total else []))
