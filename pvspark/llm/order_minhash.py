"""Near-duplicate classes by Order MinHash, verified by banded alignment.

Texts are compared as sequences of words (lower-cased, letters and digits); their k-mers are runs of five
words, labelled with their occurrence (the second time a run appears, it counts as another one). A sketch
samples the ``ELL`` least k-mers under a random order and keeps them in text order; texts with an equal sketch
are candidates. ``SKETCHES`` independent sketches are taken: two texts of similarity 0.8 share one of them
with probability of about 0.8 ** ELL, so one in 400,000 such pairs shares none.

A candidate pair is verified by aligning its k-mers in text order inside the band of shifts that a
similarity of 0.8 allows. With ``kept`` aligned k-mers the similarity is kept / (n1 + n2 - kept), an
order-preserving Jaccard similarity of five-word shingles; pairs of 0.8 or more are linked, and classes are the
connected components of the links.

Which candidates are verified. Equal texts are one text from the start. Sketches are taken up in rounds, and after each one
the classes found so far are contracted: a later bucket (equal sketch) whose texts are all of one class is done, and only
texts of different classes are compared. A bucket of up to ``SMALL`` texts is compared pair by pair. In a larger one every
text is compared with the bucket's centre, the member that meets most others. No link is lost by that: members of
larger buckets that still hold several classes are joined exactly.

* Two such texts with different centres: k-mers are ordered by rarity, and texts of similarity 0.8 share one
  of their first n - ceil(0.8 n) + 1 (prefix join).
* Two texts with the same centre: what they share is either common to both and the centre, or it is not in
  the centre. Without a shared k-mer outside the centre, each must have 0.8 / 1.8 of both sizes in common with
  the centre, which is a join on sizes; otherwise they meet in a prefix join over the k-mers that the
  centre does not have (all of them for texts near the centre). Near copies that differ from their
  original in different places therefore don't meet each other.

A pair of these joins counts only if the shared k-mer lies inside the band of both texts' alignment and if as many k-mers as
the alignment still needs follow it in the order of rarity on both sides: the first k-mer that the alignment keeps does.

Before these joins make pairs, up to ``STARS`` rounds compare each text with one other only, the one that stands for most of its
keys, and contract the classes again: a group of near copies becomes one class by as many comparisons as it has texts.
The connected components of all links so far are then taken. In what is left, a key's most frequent class is joined with the others only.

Texts sit in a table bucketed by fingerprint; sketches, pairs and labels are small rows that go to them.

Defined results: null counts as empty; texts without words are alike only if they are equal; texts of fewer
than five words have one k-mer; class_id is the least doc_id of the class (null only if it has no other);
repeated rows share their class, and rows that repeat the least id all count as kept; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pvspark.llm.common import Scratch, distinct_texts, drop_bucketed, small_batches, text_key
from pvspark.llm.components import components, hooked
from pvspark.llm.words import slices, words

SHINGLE = 5
SIMILAR = 0.8
SHARE = SIMILAR / (1 + SIMILAR)      # of both sizes together that similar texts have in common
ELL = 3
SKETCHES = 18
SMALL = 8
ROUNDS = (0, 4, SKETCHES)      # sketches of the first and the second round
STARS = 4
STAR = 1_000                   # partners of a text in one task
NEAR = 0.25                    # of a near text's k-mers are not in its centre
KNOWN_WORDS = 200_000
SLICE_ROWS, SLICE_CHARS = 1_000, 2_000_000
_U = np.uint64


def mix(a: np.ndarray, b) -> np.ndarray:
    """64-bit identifier of a pair of identifiers."""
    x = a * _U(0xBF58476D1CE4E5B9) + b * _U(0x94D049BB133111EB)
    x = x ^ (x >> _U(31))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class WordIds:
    """64-bit identifiers of words, with a bounded table of known ones."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _new(self, w: bytes) -> int:
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        v = self.known[w] = xxhash.xxh64_intdigest(w)
        return v

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        get, new, ids, sizes = self.known.get, self._new, [], []
        for t in texts:
            ws = words(t)
            sizes.append(len(ws))
            ids += [get(w) or new(w) for w in ws]
        return np.array(ids, _U), np.array(sizes, np.int64)


def kmers(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled k-mers of texts that lie end to end in ``ids`` (word identifiers), and how many each text
    has: sizes - 4, one for shorter texts, none for empty ones."""
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, (sizes > 0).astype(np.int64))
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), n)
    first = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[text]
    left = sizes[text] - (first - begin[text])             # words up to the end of the text
    h = np.zeros(len(first), _U)
    if not len(h):
        return h, n
    for j in range(SHINGLE):
        h = np.where(j < left, mix(h, ids[np.minimum(first + j, len(ids) - 1)]), h)
    order = np.lexsort((h, text))                           # stable: text order within equal k-mers
    hs, ts = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    label = np.empty(len(h), _U)
    label[order] = (np.arange(len(h)) - start).astype(_U)
    return mix(h, label), n


def sketches(grams: np.ndarray, n: np.ndarray, ell: int = ELL, count: int = SKETCHES) -> np.ndarray:
    """``count`` sketch identifiers of each text; texts must have k-mers."""
    out = np.empty((count, len(n)), _U)
    begin = np.cumsum(n) - n
    big = np.iinfo(np.uint64).max
    for s in range(count):
        keys = mix(grams, _U(0x9E3779B97F4A7C15 * (s + 1) % (1 << 64))) >> _U(1)     # below ``big``
        chosen = np.full((ell, len(n)), len(grams), np.int64)
        for e in range(ell):
            least = np.minimum.reduceat(keys, begin)
            at = np.flatnonzero(keys == np.repeat(least, n))
            of, one = np.unique(np.searchsorted(begin, at, "right") - 1, return_index=True)
            at = at[one]
            left = least[of] != big
            chosen[e, of[left]] = at[left]
            keys[at] = big
        chosen.sort(axis=0)                                  # text order
        h = np.full(len(n), s + 1, _U)
        for e in range(ell):
            h = np.where(chosen[e] < len(grams), mix(h, grams[np.minimum(chosen[e], len(grams) - 1)]), h)
        out[s] = h
    return out


def aligned(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two texts' labelled k-mers by banded alignment (0 if outside the band).

    Labelled k-mers are distinct within a text, so the best alignment is the longest increasing run of places
    in ``b`` among the common k-mers taken in the order of ``a``.
    """
    if not len(a) or not len(b):
        return 0.0
    need = ceil(SIMILAR / (1 + SIMILAR) * (len(a) + len(b)) - 1e-9)
    band = max(len(a), len(b)) - need
    if band < 0 or min(len(a), len(b)) < need:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < need:
        return 0.0
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        kept = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            tails[k:k + 1] = [x]
        kept = len(tails)
    return kept / (len(a) + len(b) - kept)


def _sketch_batches(batches):
    ids = WordIds()
    with np.errstate(over="ignore"):
        for part in slices(batches, SLICE_ROWS, 2, SLICE_CHARS):
            grams, n = kmers(*ids.of(part.column(2).to_pylist()))
            there = np.flatnonzero(n)
            keys = sketches(grams, n[there]) if len(there) else np.empty((SKETCHES, 0), _U)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(there) + 1) * SKETCHES, pa.int32()),
                                             pa.array(np.ascontiguousarray(keys.T).ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.column(0).to_numpy()[there]), pa.array(part.column(1).to_numpy()[there], pa.int32()), lists], ["did", "size", "keys"])


def _kmer_batches(batches):
    """node, centre, member, text -> one row per labelled k-mer."""
    ids = WordIds()
    with np.errstate(over="ignore"):
        for part in slices(batches, SLICE_ROWS, 3, SLICE_CHARS):
            grams, n = kmers(*ids.of(part.column(3).to_pylist()))
            take = pa.array(np.repeat(np.arange(len(n)), n))
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k).take(take) for k in range(3)), pa.array(np.repeat(n, n), pa.int32()),
                 pa.array(place, pa.int32()), pa.array(grams.view(np.int64))], ["node", "centre", "member", "n", "place", "kmer"])


def _verify_batches(batches):
    """a, b, text_a, text_b -> a, b, similarity."""
    ids = WordIds()
    with np.errstate(over="ignore"):
        for part in slices(batches, SLICE_ROWS, 2, SLICE_CHARS):
            grams, at = [], 0
            sides = part.column(2).to_pylist() + part.column(3).to_pylist()
            g, n = kmers(*ids.of(sides))
            for k in n.tolist():
                grams.append(g[at:at + k])
                at += k
            rows = part.num_rows
            sim = [aligned(grams[i], grams[rows + i]) for i in range(rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sim, pa.float64())],
                                             ["a", "b", "similarity"])


NODE = "struct<did:bigint,size:int>"
COUNTS = ("n", "common", "place", "rank", "own_rank")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among ``pairs(a, b)``: a, b, similarity. A text b with more than STAR partners is sent to several
    tasks, each with a share of them."""
    text = texts.select(F.struct("did", "size").alias("node"), "did", "size", "text")
    fans = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("int").alias("fans"))
    dealt = pairs.join(fans, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("fans")).cast("int").alias("fan"),
                                         F.col("a.did").alias("did"), F.col("a.size").alias("size"))
    left = dealt.join(text.drop("node"), ["did", "size"]).select("a", "b", "fan", F.col("text").alias("text_a"))
    right = (fans.select("b", "fans", F.col("b.did").alias("did"), F.col("b.size").alias("size"))
             .join(text.drop("node"), ["did", "size"])
             .select("b", F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("fan"), F.col("text").alias("text_b")))
    both = left.join(right, ["b", "fan"]).select("a", "b", "text_a", "text_b")
    return (both.mapInArrow(_verify_batches, f"a {NODE}, b {NODE}, similarity double")
            .filter(F.col("similarity") >= SIMILAR))


def _ordered(x, y) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _bucket_pairs(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows(node, label, keys)`` -> candidate pairs of the buckets that hold several classes; and the members of the larger ones: key,
    node, c (weight, h, node, label of the centre)."""
    each = rows.select("node", "label", F.explode("keys").alias("key"))
    split = (each.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("label").alias("x"), F.max("label").alias("y"))
             .filter("x != y").select("key", "members"))
    rows = scratch.write(each.join(split, "key"), "sketch-members")
    few = rows.filter(F.col("members") <= SMALL).select("key", "node", "label")
    other = few.select("key", F.col("node").alias("other"), F.col("label").alias("other_label"))
    pairs = (few.join(other, "key").filter("node < other and label != other_label")
             .select(*_ordered(F.col("node"), F.col("other"))))
    # the text that meets most others stands nearest to what a group has in common
    met = (rows.filter(F.col("members") > SMALL).groupBy("node", "label")
           .agg(F.sum("members").alias("weight"), F.collect_list("key").alias("keys")))
    many = met.select(F.explode("keys").alias("key"), "node", "label", F.struct("weight", F.xxhash64("node.did").alias("h"), "node", "label").alias("r"))
    centres = many.groupBy("key").agg(F.max("r").alias("c"))
    many = scratch.write(many.select("key", "node", "label").join(centres, "key"), "large-buckets")
    stars = many.filter("label != c.label").select(*_ordered(F.col("node"), F.col("c.node")))
    return pairs.unionByName(stars).distinct(), many.select("key", "node", "c")


def _rest_rows(many: DataFrame, labels: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Prefixes of the members of larger buckets that hold several classes: node, centre, n, common, kmer, place, rank,
    own_rank, any, apart. See the module's text."""
    own = many.groupBy("node").agg(F.max("c").alias("m"), F.collect_set("key").alias("keys"))
    labelled = (own.join(labels, "node", "left").select("node", F.col("m.node").alias("centre"), F.coalesce("label", "node").alias("label"),
                                                        F.explode("keys").alias("key")))
    labelled = scratch.write(labelled, "rest-members")
    split = labelled.groupBy("key").agg((F.min("label") != F.max("label")).alias("split")).filter("split").select("key")
    nodes = labelled.join(split, "key", "left_semi").select("node", "centre").distinct().withColumn("member", F.lit(True))
    centres = nodes.select(F.col("centre").alias("node")).distinct()
    extra = (centres.join(nodes.select("node"), "node", "left_anti").select("node", F.col("node").alias("centre"), F.lit(False).alias("member")))
    rows = (nodes.unionByName(extra).select("node", "centre", "member", "node.did", "node.size")
            .join(texts.select("did", "size", "text"), ["did", "size"]).select("node", "centre", "member", "text")
            .mapInArrow(_kmer_batches, f"node {NODE}, centre {NODE}, member boolean, n int, place int, kmer long"))
    rows = scratch.write(rows, "rest-kmers")
    core = rows.join(centres, "node", "left_semi").select(F.col("node").alias("centre"), "kmer", F.lit(1).alias("core"))
    rows = rows.filter("member").drop("member")
    df = rows.groupBy("kmer").agg(F.count(F.lit(1)).alias("df"))
    by = W.partitionBy("node")
    ranked = (rows.join(core, ["centre", "kmer"], "left").join(df, "kmer")
              .withColumn("own", F.when(F.col("core").isNull(), 1).otherwise(0))
              .withColumns({"rank": F.row_number().over(by.orderBy("df", "kmer")),
                            "own_rank": F.sum("own").over(by.orderBy("df", "kmer").rowsBetween(W.unboundedPreceding, 0)),
                            "common": F.col("n") - F.sum("own").over(by)}))
    length = F.col("n") - F.ceil(F.col("n") * SIMILAR - 1e-9) + 1
    near = F.col("n") - F.col("common") <= NEAR * F.col("n")
    ranked = (ranked.withColumns({"any": (F.col("rank") <= length) & (F.col("df") > 1),
                                  "apart": (F.col("own") == 1) & (F.col("df") > 1) & (near | (F.col("own_rank") <= length))})
              .filter(F.col("any") | F.col("apart") | (F.col("rank") == 1)))
    return scratch.write(ranked.select("node", "centre", "n", "common", "kmer", "place", "rank", "own_rank", "any", "apart"),
                         "rest-prefixes")


def _labelled(ranked: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.write(ranked.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "rest-labelled")


def _size_alike(n, m):
    return F.least(n, m) >= SIMILAR * F.greatest(n, m) - 1e-9


def _possible(on: list[str], x: str):
    """Whether a k-mer shared by a text and another (columns with prefix ``x``) can be the first in order of rarity that their
    alignment keeps: it lies in the band, and enough k-mers follow it on both sides."""
    n, m = F.col("n"), F.col(f"{x}n")
    need = F.ceil((n + m) * SHARE - 1e-9)
    other = (F.col("label") != F.col(f"{x}label")) & _size_alike(n, m)
    band = F.abs(F.col("place") - F.col(f"{x}place")) <= F.greatest(n, m) - need
    if on == ["kmer"]:
        return other & band & (1 + F.least(n - F.col("rank"), m - F.col(f"{x}rank")) >= need)
    own = F.least(n - F.col("common") - F.col("own_rank"), m - F.col(f"{x}common") - F.col(f"{x}own_rank"))
    return other & band & (1 + own + F.least(F.col("common"), F.col(f"{x}common")) >= need)


def _star_pairs(ranked: DataFrame, turn: int) -> DataFrame:
    """One pair a text: under each key, one text (the same for many keys) stands against those of other classes, and each text
    meets the one that it shares most keys with."""
    out = []
    for flag, on in (("any", ["kmer"]), ("apart", ["centre", "kmer"])):
        side = ranked.filter(flag)
        pick = F.struct(F.xxhash64(F.lit(turn), "node.did", "node.size").alias("h"), "node", "label", *COUNTS)
        mid = (side.groupBy(*on).agg(F.min(pick).alias("m"), F.min("label").alias("x"), F.max("label").alias("y"))
               .filter("x != y").select(*on, "m"))
        out.append(side.join(mid, on).filter(_possible(on, "m."))
                   .select("node", F.col("m.node").alias("other")))
    shared = out[0].unionByName(out[1]).groupBy("node", "other").agg(F.count(F.lit(1)).alias("keys"))
    best = shared.groupBy("node").agg(F.max(F.struct("keys", F.xxhash64(F.lit(turn), "other.did").alias("h"), "other")).alias("m"))
    return best.select(*_ordered(F.col("node"), F.col("m.other"))).distinct()


def _rest_pairs(ranked: DataFrame) -> DataFrame:
    """Pairs of different classes that may be similar, from labelled prefixes: see the module's text."""

    def meet(side: DataFrame, on: list[str], also) -> DataFrame:
        """Pairs on equal keys, the key's most frequent class being joined with the others only."""
        per_class = side.groupBy(*on, "label").agg(F.count(F.lit(1)).alias("k"))
        major = (per_class.groupBy(*on).agg(F.max(F.struct("k", "label")).alias("m"), F.count(F.lit(1)).alias("classes"))
                 .filter("classes > 1").select(*on, F.col("m.label").alias("major")))
        minor = side.join(major, on).filter("label != major").select(
            *on, F.col("node").alias("x"), F.col("label").alias("xlabel"), F.col("centre").alias("xcentre"),
            *(F.col(c).alias(f"x{c}") for c in COUNTS))
        there = side.select("node", "label", "centre", "kmer", *COUNTS)
        return minor.join(there, on).filter(_possible(on, "x") & also).select(*_ordered(F.col("x"), F.col("node")))

    others = meet(ranked.filter("any"), ["kmer"], F.col("xcentre") != F.col("centre"))
    need = F.ceil((F.col("n") + F.col("xn")) * SHARE - 1e-9)
    apart = meet(ranked.filter("apart"), ["centre", "kmer"], F.least(F.col("common"), F.col("xcommon")) < need)
    # no k-mer of their own in common: both must share enough with the centre
    one = ranked.filter("rank = 1").select("node", "label", "centre", "n", "common")
    low, high = F.ceil(F.col("n") * SIMILAR - 1e-9).cast("int"), F.least(F.col("n"), F.floor(F.col("common") / SHARE + 1e-9).cast("int") - F.col("n"))
    longer = one.filter(high >= low).select("centre", F.col("node").alias("x"), F.col("label").alias("xl"), F.col("n").alias("xn"),
                                            F.explode(F.sequence(low, high)).alias("n"))
    within = (longer.join(one, ["centre", "n"])
              .filter((F.col("xl") != F.col("label")) & (F.col("common") >= SHARE * (F.col("n") + F.col("xn")) - 1e-9))
              .select(*_ordered(F.col("x"), F.col("node"))))
    return others.unionByName(apart).unionByName(within).distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_size (rows), kept (the row with that id), and the text's
    key (did, size): one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    texts, name = distinct_texts(docs, id_col, text_col)
    sketch = scratch.write(texts.select("did", "size", "text").mapInArrow(_sketch_batches, "did long, size int, keys array<long>"),
                           "sketches").select(F.struct("did", "size").alias("node"), "keys")
    links, labels, large = None, None, []

    def linked(pairs: DataFrame, contract: bool = True) -> bool:
        """Verify pairs and contract the classes; False if there was nothing to contract."""
        nonlocal links, labels
        pairs = scratch.write(pairs, "pairs")
        if links is not None and pairs.isEmpty():
            return False
        found = scratch.write(_verified(pairs, texts), "verified")
        more = not found.isEmpty()
        if links is None or more:
            links = found if links is None else links.unionByName(found)
            if contract:
                labels = hooked(links, scratch.write)
        return more

    for low, high in zip(ROUNDS, ROUNDS[1:], strict=False):
        rows = sketch.select("node", F.slice("keys", low + 1, high - low).alias("keys"))
        rows = rows.withColumn("label", F.col("node")) if labels is None else (
            rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
        pairs, many = _bucket_pairs(rows, scratch)
        large.append(many)
        linked(pairs)
    prefixes = _rest_rows(reduce(DataFrame.unionByName, large), labels, texts, scratch)
    if not prefixes.isEmpty():
        for turn in range(STARS):
            if not linked(_star_pairs(_labelled(prefixes, labels, scratch), turn)):
                break
        labels = components(links, materialise=scratch.write)      # whole classes, before the pairs that are left meet
        linked(_rest_pairs(_labelled(prefixes, labels, scratch)), contract=False)
    labels = components(links, materialise=scratch.write)
    of = (texts.select(F.struct("did", "size").alias("node"), "copies", "least_id").join(labels, "node", "left")
          .select("node", F.coalesce("label", "node").alias("label"), "copies", "least_id"))
    of = scratch.write(of, "text-classes")
    classes = of.groupBy("label").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"))
    result = scratch.keep(of.join(classes, "label").select("node.did", "node.size", "class_id", "class_size"), "near-classes")
    drop_bucketed(spark, name)
    scratch.clear()
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *text_key(F.col(text_col)))
            .join(result, ["did", "size"])
            .select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
                    "did", "size"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class (the least doc_id's; rows with its id and text all stay)."""
    gone = (near_classes(docs, id_col, text_col).filter(~F.col("kept"))
            .select(F.col("did").alias("__did"), F.col("size").alias("__size"), F.col("doc_id").alias("__id")).distinct())
    keyed = docs.withColumns({"__x": F.struct(*text_key(F.col(text_col)))})
    return (keyed.join(gone, (F.col("__x.did") == F.col("__did")) & (F.col("__x.size") == F.col("__size"))
                       & F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")), "left_anti").drop("__x"))
