"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

A source's target is its share of all words by weight; targets stop at ``cap`` times the source's size, and the
excess is shared again by weight among the others until none is above. With ratio = target / size, every
document of the source is taken floor(ratio) times, and once more with probability f = ratio - floor(ratio).

Those last copies are settled by pivotal rounding. A document holds f * size words of mass, between 0 (no further
copy) and size (one more). Two documents exchange mass at random, without bias, until one of them is empty or
full; the other goes on with what is left. The mass of a source never changes, so its words miss the target by less
than the one document that is left, whose coin is the last. For this to be a small one, documents above a
``HEAVY``-th of their source (fewer than ``HEAVY`` of them) come first, the largest before the others: each is paired
with all smaller ones together, which give or take its mass in proportion. Residuals of the others meet in a reduction
tree: units are dealt into blocks of about ``BLOCK`` by a hash, a fold over each block leaves one residual, residuals
are blocks of the next level, until a source has one block. A source that holds a third of all rows is thus as many
blocks as it needs. Mass is counted in whole millionths of a word, and all draws are hashes of seed, level and document: reruns agree.

Rows with equal id, source and size are one unit with a count: their common mass is settled as a whole, so repeated
rows don't fill a block. The targets come from rounds of one aggregation over the sources; ranks of sources come from
range partitions, so any number of sources will do.

Defined results: null text has size 0; documents of size 0 are taken 0 times and their source's target counts their
0 words; the null source is a source, ordered last; null ids are ids like any other; of rows with equal id, source and
size any may get the further copy; without any words all targets are 0; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pvspark.llm.common import Scratch
from pvspark.operators.ranks import numbered

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK = 64
HEAVY = 100
SEED = 20
UNIT = 1_000_000               # mass of a word
CHUNK = 100_000                # repeated rows that one task writes
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def targets(totals: DataFrame, weights: Sequence[int], cap: int, scratch: Scratch) -> DataFrame:
    """``totals(source, source_size, rows)`` with rank, weight and target (double)."""
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = numbered(totals, [F.col("source").asc_nulls_last()], path=scratch.path("mix-sources"))
    sources = scratch.write(sources.withColumn("weight", weight.cast("bigint")), "mix-weights")
    total = F.sum(F.lit(1.0) * F.col("source_size"))
    row = sources.agg(total.alias("words"), F.sum("weight").alias("weights")).collect()[0]
    words, level = row.words or 0.0, (row.words or 0.0) / (row.weights or 1)
    while True:
        # sources at their cap give what they can't use to the others
        at_cap = F.lit(level) * F.col("weight") > F.lit(float(cap)) * F.col("source_size")
        row = sources.agg(F.sum(F.when(at_cap, F.lit(float(cap)) * F.col("source_size"))).alias("used"),
                          F.sum(F.when(~at_cap, F.col("weight"))).alias("weights")).collect()[0]
        new = (words - (row.used or 0.0)) / row.weights if row.weights else level
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), F.lit(float(cap)) * F.col("source_size")))


_DONE = "array<struct<id:bigint,size:bigint,n:bigint,k:bigint>>"
_OPEN = "array<struct<id:bigint,size:bigint,n:bigint,k:bigint,mass:bigint>>"


def _meet(acc: Column, x: Column) -> Column:
    """The residual ``acc`` and the unit ``x`` exchange mass until one of them is empty or full."""
    mass = acc["mass"] + x["mass"]
    up = F.least(acc["whole"] - acc["mass"], x["mass"])
    down = F.least(acc["mass"], x["whole"] - x["mass"])
    to_acc = x["u"] * (up + down) < down                    # the chance that leaves both expectations as they are
    settled = F.when(to_acc, mass >= acc["whole"]).otherwise(mass <= x["whole"])      # is it ``acc`` that is settled?
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def done(u, more):
        return F.concat(acc["done"], F.array(F.struct(u["id"].alias("id"), u["size"].alias("size"), u["n"].alias("n"),
                                                      (u["k"] + more).alias("k"))))

    def state(done_, u, left):
        return F.struct(done_.alias("done"), u["id"].alias("id"), u["size"].alias("size"), u["n"].alias("n"),
                        u["k"].alias("k"), left.alias("mass"), u["whole"].alias("whole"))

    return (F.when(settled, state(done(acc, F.when(to_acc, one).otherwise(none)), x,
                                  F.when(to_acc, mass - acc["whole"]).otherwise(mass)))
            .otherwise(state(done(x, F.when(to_acc, none).otherwise(one)), acc,
                             F.when(to_acc, mass).otherwise(mass - x["whole"]))))


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0 ** -53)


def _pair_with_rest(acc: Column, x: Column) -> Column:
    """The heavy unit ``x`` and all smaller ones (``mass`` of ``whole``) exchange mass until ``x`` is settled or the others can't
    go on. A smaller unit's mass is a * mass + b * whole."""
    full = x["whole"].cast("double")
    m = acc["a"] * x["mass"] + acc["b"] * full
    mass, whole = acc["mass"] - m, acc["whole"] - full
    up, down = F.least(full - m, F.greatest(mass, F.lit(0.0))), F.least(m, F.greatest(whole - mass, F.lit(0.0)))
    to_x = x["u"] * (up + down) < down
    settled = F.when(to_x, up >= full - m).otherwise(down >= m)
    shrink = F.when(to_x & (mass > 0), (mass - up) / mass).otherwise(F.lit(1.0))
    grow = F.when(~to_x & (whole > mass), (whole - mass - down) / (whole - mass)).otherwise(F.lit(1.0))
    unit = [x[c].alias(c) for c in ("id", "size", "n")]
    done = F.struct(*unit, (x["k"] + F.when(to_x, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("k"))
    still = F.struct(*unit, x["k"].alias("k"), F.round(F.when(to_x, m + up).otherwise(m - down)).cast("bigint").alias("mass"))
    return F.struct(F.when(settled, F.concat(acc["done"], F.array(done))).otherwise(acc["done"]).alias("done"),
                    F.when(settled, acc["open"]).otherwise(F.concat(acc["open"], F.array(still))).alias("open"),
                    F.when(to_x, mass - up).otherwise(mass + down).alias("mass"), whole.alias("whole"),
                    (acc["a"] * shrink * grow).alias("a"), (acc["b"] * shrink * grow + 1 - grow).alias("b"))


def _heavy(units: DataFrame) -> DataFrame:
    """rank and the outcome ``f`` of each source's heavy units: done, open, and a, b for its other units."""
    heavy = F.col("mass") > 0
    heavy = heavy & (F.col("size") * HEAVY > F.col("source_size"))
    # larger ones first; at most HEAVY - 1 a source
    item = F.struct((-F.col("size")).alias("o"), "id", "size", "n", "k", "mass", "whole",
                    _uniform(F.lit("heavy"), F.lit(SEED), F.col("id"), F.col("size")).alias("u"))
    per = units.filter("mass > 0").groupBy("rank").agg(F.sum("mass").cast("double").alias("mass"), F.sum("whole").cast("double").alias("whole"),
                                                       F.array_sort(F.collect_list(F.when(heavy, item))).alias("xs"))
    start = F.struct(F.array().cast(_DONE).alias("done"), F.array().cast(_OPEN).alias("open"), F.col("mass").alias("mass"),
                     F.col("whole").alias("whole"), F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))
    return per.select("rank", F.aggregate("xs", start, _pair_with_rest).alias("f"))


def _level(units: DataFrame, level: int) -> DataFrame:
    """One level of the tree: rank, blocks, and the fold of each block (settled units and the residual)."""
    mark = [F.lit(SEED), F.lit(level), F.col("id"), F.col("size")]
    block = F.pmod(F.xxhash64(F.lit("block"), *mark), F.col("blocks"))
    item = F.struct(F.xxhash64(F.lit("order"), *mark).alias("h"), "id", "size", "n", "k", "mass", "whole",
                    _uniform(F.lit("draw"), *mark).alias("u"))
    blocks = units.select("rank", "blocks", block.alias("block"), item.alias("x")).groupBy("rank", "block", "blocks").agg(
        F.array_sort(F.collect_list("x")).alias("xs"))
    first = F.col("xs")[0]
    start = F.struct(F.array().cast(_DONE).alias("done"), first["id"].alias("id"), first["size"].alias("size"), first["n"].alias("n"),
                     first["k"].alias("k"), first["mass"].alias("mass"), first["whole"].alias("whole"))
    return blocks.select("rank", "blocks", F.aggregate(F.slice("xs", F.lit(2), F.size("xs")), start, _meet).alias("f"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per distinct (doc_id, source, size): n (rows), low (copies of each row), k (rows with one copy more),
    source_size, target."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = scratch.write(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"),
                                     word_count(F.col(text_col)).alias("size")), "mix-sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    low = F.least(F.floor("ratio"), F.lit(cap - 1))
    sources = targets(totals, weights, cap, scratch).withColumn("ratio", ratio)
    full = F.col("ratio") >= cap
    sources = scratch.write(sources.withColumns({
        "low": F.when(full, F.lit(cap)).otherwise(low).cast("int"), "part": F.when(full, F.lit(0.0)).otherwise(F.col("ratio") - low),
        "blocks": F.ceil(F.col("rows") / BLOCK)}), "mix-targets")
    most = sources.agg(F.max("blocks").alias("m")).collect()[0].m or 0

    # equal units are counted map-side before they move; the source's row is small and unique
    units = (rows.join(sources.select(F.col("source").alias("s"), "rank", "part", "blocks", "source_size"), F.col("source").eqNullSafe(F.col("s")))
             .groupBy("rank", "id", "size", "part", "blocks", "source_size").agg(F.count(F.lit(1)).alias("n")))
    share = F.when(F.col("size") > 0, F.col("n") * F.col("part")).otherwise(F.lit(0.0))
    units = units.withColumn("k", F.floor(share)).withColumn("whole", F.col("size") * UNIT).withColumn(
        "mass", F.round((share - F.col("k")) * F.col("whole")).cast("bigint"))
    units = scratch.write(units.select("rank", "id", "size", "n", "k", "mass", "whole", "blocks", "source_size"), "mix-units")
    heavy = scratch.write(_heavy(units), "mix-heavy")
    rest = (units.filter((F.col("mass") > 0) & (F.col("size") * HEAVY <= F.col("source_size")))
            .join(heavy.select("rank", "f.a", "f.b"), "rank")
            .withColumn("mass", F.least(F.col("whole"), F.greatest(F.lit(0), F.round(F.col("a") * F.col("mass") + F.col("b") * F.col("whole")))
                                        .cast("bigint"))))
    still = (heavy.select("rank", F.explode("f.open").alias("d")).select("rank", "d.*").withColumn("whole", F.col("size") * UNIT)
             .join(sources.select("rank", "blocks"), "rank"))
    columns = ["rank", "id", "size", "n", "k", "mass", "whole", "blocks"]
    settled = (units.filter("mass = 0").select("rank", "id", "size", "n", "k")
               .unionByName(heavy.select("rank", F.explode("f.done").alias("d")).select("rank", "d.*")))
    left, level = rest.select(*columns).unionByName(still.select(*columns)), 0
    while most >= 1:
        level += 1
        folded = scratch.write(_level(left, level), "mix-level")
        settled = settled.unionByName(folded.select("rank", F.explode("f.done").alias("d")).select("rank", "d.*"))
        coin = _uniform(F.lit("last"), F.lit(SEED), F.col("id"), F.col("size")) * F.col("whole") < F.col("mass")
        rest = folded.select("rank", "blocks", "f.id", "f.size", "f.n", "f.k", "f.mass", "f.whole")
        last = rest.filter("blocks = 1").withColumn("k", F.col("k") + F.when(coin, 1).otherwise(0))
        settled = settled.unionByName(last.select("rank", "id", "size", "n", "k"))
        left = rest.filter("blocks > 1").withColumn("blocks", F.ceil(F.col("blocks") / BLOCK))
        most = 0 if most == 1 else -(-most // BLOCK)
    out = scratch.keep(settled.join(sources.select("rank", "source", "source_size", "target", "low"), "rank")
                       .select(F.col("id").alias("doc_id"), "source", "size", "n", "low", "k", "source_size", "target"), "mix")
    scratch.clear()
    return out


def per_row(plan: DataFrame) -> DataFrame:
    """The plan with one row per document: doc_id, source, size, source_size, target, copies, taken (words)."""
    def rows(df, count, first):
        at = F.explode(F.sequence(first, first + count - 1))
        return df.select(*[c for c in df.columns if c not in ("first", "count")], at.alias("at"))

    few = rows(plan.filter(F.col("n") <= CHUNK).withColumns({"first": F.lit(1).cast("bigint"), "count": F.col("n")}), F.col("count"), F.col("first"))
    chunks = (plan.filter(F.col("n") > CHUNK)
              .select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"), F.lit(CHUNK).cast("bigint"))).alias("first"))
              .withColumn("count", F.least(F.lit(CHUNK).cast("bigint"), F.col("n") - F.col("first") + 1))
              .repartition("doc_id", "first"))
    copies = F.col("low") + F.when(F.col("at") <= F.col("k"), 1).otherwise(0)
    return (few.unionByName(rows(chunks, F.col("count"), F.col("first"))).withColumn("copies", copies)
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, all columns. Equal rows are numbered per
    input partition first, so that no group of them is sorted as a whole."""
    plan = mix(docs, weights, cap, id_col, text_col, source_col)
    scratch = Scratch(docs.sparkSession)
    names = docs.columns
    keyed = docs.select(F.struct(*names).alias("__row"), F.col(id_col).cast("bigint").alias("__id"), F.col(source_col).cast("string").alias("__source"),
                        word_count(F.col(text_col)).alias("__size"))
    same = (F.col("__id").eqNullSafe(F.col("doc_id")) & F.col("__source").eqNullSafe(F.col("source")) & (F.col("__size") == F.col("size")))
    found = keyed.join(plan, same).select("__row", "doc_id", "source", "size", "n", "low", "k")
    single = found.filter("n = 1").withColumn("at", F.lit(1))
    key = ["doc_id", "source", "size"]
    many = scratch.keep(found.filter("n > 1").withColumn("part", F.spark_partition_id()), "mix-repeated")
    counts = many.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("c"))
    before = counts.select(*[F.col(c).alias(f"__{c}") for c in [*key, "part"]], F.coalesce(F.sum("c").over(
        W.partitionBy(*key).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    again = F.lit(True)
    for c in [*key, "part"]:
        again = again & F.col(c).eqNullSafe(F.col(f"__{c}"))
    local = F.row_number().over(W.partitionBy(*key, "part").orderBy(F.lit(0)))
    many = many.withColumn("local", local).join(before, again).select("__row", *key, "n", "low", "k", (F.col("before") + F.col("local")).alias("at"))
    copies = F.col("low") + F.when(F.col("at") <= F.col("k"), 1).otherwise(0)
    return (single.unionByName(many).select("__row", copies.alias("__copies")).filter("__copies > 0")
            .select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("__row.*"))
