"""Line dedup by a deletion-neighbourhood join (DataFrame functions only).

Lines (split at line feeds, blank ones left out) are compared as sequences of lower-cased words. Equal lines are
one line with an earliest place. Of lines with at least ``MIN_WORDS`` words, two are also alike if one word
inserted, deleted or replaced turns one into the other. Every line emits its deletion variants as hashed keys:
the line itself and the line without word i, for each i. Two lines differ by a replaced word exactly if they
share the variant without word i for the same i, and by an inserted one exactly if the shorter line equals a
variant of the longer. A line goes if an earlier one (by doc_id, text fingerprint, line number) is equal or
alike; the earliest alike line is found by minima over the keys, not by listing pairs, and its edit distance
is verified on the words.

Only lines that can have a neighbour emit variants: after one edit, either the first or the last half of the
words is the same at the same length class, so lines whose two halves are shared by no other line are done,
and the others leave out only words of the half that differs.

Texts are split twice: for the lines, and for their places, which also give each row's number of lines.

A line of n words costs about n times ``BLOCK / 2`` small steps: the keys of its variants are running hashes.

Skew: all minima combine map-side, and joins back to the rows are on keys with one row each, so a line that a
third of all documents repeat is one row a task in those shuffles. Places of lines that hold more than 1 in
``HOT`` of all places (so fewer than ``HOT`` lines, broadcast without their words) find their line before the last shuffle.

Defined results: null counts as empty; a null doc_id comes last; rows that repeat id and text are at one place
and don't remove each other's lines; documents without lines have zero counts; a hash collision found by the
verification leaves the line in; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import bucketed, drop_bucketed, materialise

MIN_WORDS = 8
BLOCK = 64                             # words whose keys are summed in one step
HOT = 2000                             # a line with more than 1 / HOT of all places is hot, so there are fewer than HOT of them
LAST = (1 << 63) - 1                   # place of a null doc_id
SPACES = "\t\x0b\f\r"              # and the space itself


def _plain(line: Column) -> Column:
    """The words of a line with one space between; only lines that need it pay for more than a look."""
    odd = F.lit(False)
    for c in SPACES:
        odd = odd | F.contains(line, F.lit(c))
    line = F.trim(F.when(odd, F.translate(line, SPACES, "    ")).otherwise(line))
    return F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line)


def _split(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, did, line, words (joined by single spaces): one row per line, blank ones too (a filter here would be pushed down to
    the lines, whose words would be made twice; and a line is lower-cased faster than a text with any other letter than ASCII)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("did"),
                        F.posexplode(F.split(text, "\n")).alias("line", "t"))
            .select("doc_id", "did", "line", _plain(F.lower("t")).alias("words")))


def _place() -> Column:
    return F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "did", "line").alias("place")


def _key() -> list[Column]:
    """k, size: hash and bytes of the words."""
    return [F.xxhash64("words").alias("k"), F.octet_length("words").alias("size")]


def _halves(n: Column, words: Column) -> Column:
    """Keys of both halves, as a line of its length and as one of a word less: (hash, side). The halves of the two lengths differ
    in one of the sides only, so three pieces are cut out."""
    a, even = F.floor(n / 2).cast("int"), n % 2 == 0
    cut = lambda k: F.call_function("substring_index", words, F.lit(" "), k)
    head, tail, third = cut(a), cut(-a), cut(F.when(even, a - 1).otherwise(-a - 1))
    key = lambda side, m, part: F.struct(F.xxhash64(F.lit(side), m, part).alias("half"), F.lit(side == "head").alias("head"))
    return F.array(key("head", n, head), key("tail", n, F.when(even, tail).otherwise(third)),
                   key("head", n - 1, F.when(even, third).otherwise(head)), key("tail", n - 1, tail))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: an expression that a lambda refers to is computed anew for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _xor(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))


def _placed(ws: Column) -> Column:
    """One hash per word and place."""
    return F.transform(ws, lambda w, j: F.xxhash64(w, j))


def _sequence_key(ws: Column) -> Column:
    """Exclusive or of the hashes of words and places: a single word can be taken out of it again."""
    return _xor(_placed(ws))


def _variants(ws: Column, n: Column, drop: Column) -> Column:
    """(i, v): key of the words without word i (from 1), for the places in ``drop``.

    Leaving out word i + 1 instead of word i changes one place, where word i then stands instead of word i + 1, so the keys are
    running exclusive ors over those changes. They are summed by blocks of ``BLOCK`` words, so a line costs about n times
    ``BLOCK / 2`` small steps instead of n copies of its words.
    """
    first = _sequence_key(F.slice(ws, F.lit(2), n))
    steps = F.zip_with(_placed(F.slice(ws, F.lit(1), n - 1)), _placed(F.slice(ws, F.lit(2), n)), lambda a, b: a.bitwiseXOR(b))

    def running(x):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                             lambda b: _xor(F.slice(x.steps, b * BLOCK + 1, F.lit(BLOCK))))
        return _let(blocks, lambda sums: _let(
            F.transform(sums, lambda _, b: _xor(F.slice(sums, F.lit(1), b)).bitwiseXOR(x["first"])),
            lambda base: F.transform(drop, lambda i: F.struct(i.alias("i"), F.xxhash64(n - 1, F.get(
                base, F.floor((i - 1) / BLOCK).cast("int")).bitwiseXOR(_xor(F.slice(
                    x.steps, F.floor((i - 1) / BLOCK).cast("int") * BLOCK + 1, F.pmod(i - 1, F.lit(BLOCK)))))).alias("v")))))

    return _let(F.struct(first.alias("first"), steps.alias("steps")), running)


def _one_edit(a: Column, b: Column) -> Column:
    """Word edit distance of at most one."""
    n, m = F.size(a), F.size(b)
    # the shorter list is filled up with nulls, so the first difference lies at most one place behind its end
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    rest = lambda x, k: F.slice(x, k, F.lit(LAST >> 32).cast("int"))
    return (F.when(first == 0, True)
            .when(n == m, rest(a, first + 1) == rest(b, first + 1))
            .when(n + 1 == m, rest(a, first) == rest(b, first + 1))
            .when(n == m + 1, rest(a, first + 1) == rest(b, first)).otherwise(False))


def _near(lines: DataFrame) -> DataFrame:
    """k, size, partner (place of the earliest alike line, earlier than the line's own first place), verified."""
    # counted and shared by the same keys, which are made once
    halves = (materialise(lines.filter(F.col("n") >= MIN_WORDS).select("k", "size", _halves(F.col("n"), F.col("words")).alias("x")), "half-keys")
              .select("k", "size", F.explode("x").alias("x")).select("k", "size", "x.half", "x.head"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("half")
    able = (halves.join(shared, "half").groupBy("k", "size")
            .agg(F.max("head").alias("head"), F.max(~F.col("head")).alias("tail")))
    able = materialise(able, "line-halves")
    n = F.col("n")
    # shared head: a word of the second half differs; shared tail: one of the first
    drop = F.array_distinct(F.concat(
        F.when(F.col("head"), F.sequence(F.floor((n - 1) / 2).cast("int") + 1, n)).otherwise(F.array().cast("array<int>")),
        F.when(F.col("tail"), F.sequence(F.lit(1), F.floor(n / 2).cast("int") + 1)).otherwise(F.array().cast("array<int>"))))
    keys = F.concat(F.array(F.struct(F.lit(0).alias("i"), F.xxhash64(n, _sequence_key(F.col("ws"))).alias("v"))),
                    _variants(F.col("ws"), n, drop))
    variants = materialise(lines.join(able, ["k", "size"]).withColumn("ws", F.split("words", " "))
                           .select("k", "size", "first", F.explode(keys).alias("x"))
                           .select("k", "size", "first", "x.i", "x.v"), "line-variants")
    ref = F.struct(F.col("first"), F.col("k"), F.col("size"))
    least = variants.groupBy("v", "i").agg(F.min(ref).alias("ref"), F.count(F.lit(1)).alias("c"))
    least = materialise(least, "variant-minima")
    replaced = least.filter("i > 0 and c > 1").select("v", "i", "ref")
    whole = least.filter("i = 0").select("v", F.col("ref").alias("ref"))
    shorter = least.filter("i > 0").groupBy("v").agg(F.min("ref").alias("ref")).join(whole.select("v"), "v", "left_semi")
    whole = whole.join(shorter.select("v"), "v", "left_semi")
    found = (variants.filter("i > 0").join(replaced, ["v", "i"]).select("k", "size", "first", "ref")
             .unionByName(variants.filter("i > 0").join(whole, "v").select("k", "size", "first", "ref"))
             .unionByName(variants.filter("i = 0").join(shorter, "v").select("k", "size", "first", "ref"))
             .filter(F.col("ref.first") < F.col("first"))
             .groupBy("k", "size").agg(F.min("ref").alias("ref")))
    mine = found.join(lines.select("k", "size", "words"), ["k", "size"]).select(
        F.col("k").alias("xk"), F.col("size").alias("xs"), F.col("words").alias("xw"), F.col("ref.first").alias("partner"),
        F.col("ref.k").alias("k"), F.col("ref.size").alias("size"))
    return (mine.join(lines.select("k", "size", "words"), ["k", "size"])
            .filter(_one_edit(F.split("xw", " "), F.split("words", " ")))
            .select(F.col("xk").alias("k"), F.col("xs").alias("size"), "partner"))


def _repeated(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The result of ``repeated_lines``; and doc_id, did, line, k, size of all lines (size 0: blank)."""
    spark = docs.sparkSession
    given = _split(docs, id_col, text_col)
    spaces = F.col("size") - F.octet_length(F.replace("words", F.lit(" "), F.lit("")))
    lines, name = bucketed(
        given.select(*_key(), _place(), "words").groupBy("k", "size")
        .agg(F.min("place").alias("first"), F.first("words").alias("words"), F.count(F.lit(1)).alias("c"))
        .filter("words != ''").withColumn("n", spaces + 1),
        ["k", "size"], "lines")
    near = materialise(_near(lines), "near-lines")
    known = lines.select("k", "size", "first", "c").join(near, ["k", "size"], "left")
    total = lines.agg(F.sum("c")).first()[0] or 0
    hot = F.broadcast(known.filter(F.col("c") * HOT > total).select("k", "size", F.struct("first", "partner").alias("hot")))
    numbers = materialise(given.select("doc_id", "did", "line", *_key()), "line-numbers")
    # places of hot lines know their line already: they go on with scattered keys, which no line has to meet
    places = (numbers.filter("size > 0").select("k", "size", _place()).join(hot, ["k", "size"], "left")
              .withColumn("k", F.when(F.col("hot").isNull(), F.col("k")).otherwise(F.xxhash64("place"))))
    gone = (places.join(known.select("k", "size", F.struct("first", "partner").alias("line")), ["k", "size"], "left")
            .select("place", F.coalesce("hot", "line").alias("line")).select("place", "line.first", "line.partner")
            .filter((F.col("place") != F.col("first")) | F.col("partner").isNotNull())
            .select("place.doc", "place.did", "place.line", (F.col("place") == F.col("first")).alias("near"),
                    F.when(F.col("place") == F.col("first"), F.col("partner")).otherwise(F.col("first")).alias("earlier")))
    gone = materialise(gone, "repeated-lines")
    drop_bucketed(spark, name)
    return gone, numbers


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, did, line, near (alike, else equal), earlier (place of the line that stays): one row per line that goes."""
    return _repeated(docs, id_col, text_col)[0]


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines cut out of the text; all columns stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    gone = (repeated_lines(docs, id_col, text_col).groupBy(F.col("doc").alias("__doc"), F.col("did").alias("__did"))
            .agg(F.collect_set("line").alias("__gone")))
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    return (docs.withColumns({"__doc": F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)), "__did": F.xxhash64(text)})
            .join(gone, ["__doc", "__did"], "left")
            .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept))
            .select(*docs.columns))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (not blank), n_equal and n_alike (lines that go), dropped_lines (their numbers, from 0)."""
    gone, numbers = _repeated(docs, id_col, text_col)
    gone = (gone.distinct().groupBy("doc", "did")
            .agg(F.count_if(~F.col("near")).alias("n_equal"), F.count_if("near").alias("n_alike"),
                 F.array_sort(F.collect_list("line")).alias("gone")))
    zero = F.lit(0).cast("bigint")
    # rows that repeat id and text have the same lines, and each has a first one
    rows = numbers.groupBy("doc_id", "did").agg(F.count_if(F.col("size") > 0).alias("lines"), F.count_if(F.col("line") == 0).alias("rows"))
    return (rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "did", F.expr("lines div rows").alias("n_lines"),
                        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
            .join(gone, ["doc", "did"], "left")
            .select("doc_id", "n_lines", F.coalesce("n_equal", zero).alias("n_equal"),
                    F.coalesce("n_alike", zero).alias("n_alike"),
                    F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("dropped_lines")))
