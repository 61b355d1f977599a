"""Deterministic keep-one-row-per-key, and K8/R3: upsert by key.

``dropDuplicates`` keeps an arbitrary row of each key; here the survivor is fixed by an explicit
total order. Two plans are offered:

* ``window`` (default): ``row_number() = 1`` over (key ORDER BY spec). Spark inserts a partial
  ``WindowGroupLimit`` *before* the shuffle, so each map task forwards at most one row per key:
  a key holding a third of the rows does not land whole in one reducer.
* ``min_by``: ``groupBy(key).agg(min_by(struct(*), order_struct))`` - partial aggregation, the same
  map-side reduction. Needs every DESC column to be numeric (it is negated).

NULL keys form one group, as in ``dropDuplicates``. Null ordering follows ANSI/DuckDB defaults
(NULLS LAST for both directions) so oracles agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pvspark.session import remove_path, scratch_path


def _parse(spec: str) -> tuple[str, bool]:
    parts = spec.strip().split()
    name = parts[0]
    desc = len(parts) > 1 and parts[1].lower() == "desc"
    return name, desc


def order_columns(order: Sequence[str]) -> list[Column]:
    cols = []
    for s in order:
        name, desc = _parse(s)
        cols.append(F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_last())
    return cols


def default_order(df: DataFrame, key: Sequence[str], latest: str | None = "ingestion_ts") -> list[str]:
    """Latest ``ingestion_ts`` first, then every remaining orderable column ascending."""
    out = []
    if latest and latest in df.columns:
        out.append(f"{latest} desc")
    for f in df.schema.fields:
        if f.name in key or f.name == latest:
            continue
        if isinstance(f.dataType, (T.MapType, T.VariantType)):
            continue
        out.append(f.name)
    return out


def _negated(c: Column, dt: T.DataType, name: str) -> Column:
    """An order-reversing image of a DESC column, so one ascending ``min_by`` serves mixed orders."""
    if isinstance(dt, T.NumericType):
        return -c
    if isinstance(dt, T.TimestampNTZType):
        # zone-free wall-clock microseconds (a cast to TIMESTAMP would go through the session
        # zone, where a DST gap could merge two distinct wall times)
        days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
        micros = (F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000
                  + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))
        return -(days * 86_400_000_000 + micros)
    if isinstance(dt, T.TimestampType):
        return -F.unix_micros(c)
    if isinstance(dt, T.DateType):
        return -F.datediff(c, F.lit("1970-01-01").cast("date"))
    raise ValueError(f"min_by dedup cannot reverse DESC column {name} of type {dt.simpleString()}")


def dedup_latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str] | None = None,
                 method: str = "window") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order) if order is not None else default_order(df, keys)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order_columns(order))
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if method == "min_by":
        types = dict((f.name, f.dataType) for f in df.schema.fields)
        comps = []
        for i, s in enumerate(order):
            name, desc = _parse(s)
            c = F.col(name)
            if desc:
                c = _negated(c, types[name], name)
            # (is_null, value): non-null values sort first, i.e. NULLS LAST
            comps.append(F.struct(c.isNull().alias("n"), c.alias("v")).alias(f"o{i}"))
        rest = [c for c in df.columns if c not in keys]
        agg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*comps)).alias("_row"))
        return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
    raise ValueError(f"unknown dedup method {method!r}")


def upsert_latest(current: DataFrame, updates: DataFrame, key: str | Sequence[str],
                  version_col: str) -> DataFrame:
    """Union the current table with new rows and keep the newest version per key."""
    both = current.unionByName(updates, allowMissingColumns=True)
    return dedup_latest(both, key, [f"{version_col} desc"] + [c for c in both.columns
                                                            if c not in ([key] if isinstance(key, str) else key)
                                                            and c != version_col
                                                            and not isinstance(both.schema[c].dataType, (T.ArrayType, T.MapType))])


BUCKETS = 64


def id_bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def create_buckets(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """A table of unique keys, partitioned by ``bucket`` (a hash of the key)."""
    df.withColumn("bucket", id_bucket(key, buckets)).repartition("bucket").write.partitionBy("bucket").parquet(path)


def upsert_buckets(path: str, updates: DataFrame, key: str, version_col: str, buckets: int = BUCKETS) -> list[int]:
    """K8 / R3 by bucket: the newest version of each key, rewriting only the buckets that ``updates`` touch; the others' files
    stay as they are. Returns the touched buckets.

    ``buckets`` is the table's number, so the list of touched ones is bounded by it. The merged buckets are written to the
    scratch folder first: the table never reads what it overwrites, and a lost job can be run again.
    """
    spark = updates.sparkSession
    new = updates.withColumn("bucket", id_bucket(key, buckets))
    touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
    if not touched:
        return []
    table = spark.read.parquet(path)
    old = table.filter(F.col("bucket").isin(touched))               # partition filter: other folders are not listed
    merged = upsert_latest(old, new.select(*old.columns), key, version_col)
    stage = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    merged.write.partitionBy("bucket").parquet(stage)
    (spark.read.schema(table.schema).parquet(stage).repartition("bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))
    remove_path(spark, stage)
    return touched
