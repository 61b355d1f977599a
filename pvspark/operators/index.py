"""TF-IDF search over an inverted index, as tables.

``build`` fits the vocabulary (every word, no hashing) and writes three tables: the words' lists, the vocabulary, and the
documents' vectors. Documents are put together to segments of about BLOCK words as they are read; within a segment they are
numbered by (key, id), and a list holds the places and counts of one word in one segment. So the words of a document are never
shuffled one by one: a segment's distinct words meet the vocabulary and go back to the segment, whose counts are one row,
to make its vectors; and a filter key costs no further lists.
``search`` is exact and reads the lists of words that queries have:

* a segment meets the queries that can have documents there (a query with a key: those of that key, which are neighbours);
* a query's words come with the largest possible share first; once the sum of what is left can't bring more than a few
  documents to the k-th best sum so far, the other words are looked up for these documents only;
* ``k`` documents a query leave a segment, and the k best of all are scored in full from their vectors.

Scores are cosines of tf * ln((n + 1) / (df + 1)) vectors, compared at 9 decimals; ties go to the smaller id. Documents
without a common word have score 0 and fill up results of fewer than k.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pvspark.session import scratch_path, shuffles_dropped

NOT_WORD = r"[^\p{L}\p{N}]+"
BLOCK = 1_500_000           # words of a segment's texts
PLACES = 32_767             # documents of a segment at most, so that places are short
SEEDS = 8                   # words of a query after which the bounds are looked at first
LOT = 4_096                 # queries that meet a segment at once
EPS = 1e-9


@dataclass(frozen=True)
class Index:
    vocabulary: DataFrame       # term, df, idf
    vectors: DataFrame          # doc, key, vec array<struct<term, df, w>>
    lists: DataFrame            # seg, term, at array<place>, tf array<count>, a row for each word of a segment
    places: DataFrame           # seg, n (place), doc, key, norm


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _counts(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """keep..., term, tf; a row's words combine in its own task."""
    rows = df.select(*keep, F.explode(words(text)).alias("term"))
    return rows.groupBy(*[c for c in rows.columns]).agg(F.count(F.lit(1)).alias("tf"))


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def _array(of: pa.DataType, lengths: np.ndarray, values) -> pa.ListArray:
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(values, of) if isinstance(values, np.ndarray) else values)


def _segment_lists(seg: int, rows: pa.Table) -> pa.RecordBatch:
    """Rows (doc, key, words) of a segment -> a row for each word (numbered by code) with its places and counts, and one without
    a word that has all of them in the codes' order, the lists' lengths, the ids and the keys.
    Lists are empty in place of null, since Spark goes over all null lists of a batch for each further row."""
    size, texts = rows.num_rows, rows["words"].combine_chunks()
    order = pc.sort_indices(rows, sort_keys=[("key", "ascending"), ("doc", "ascending")])
    place = np.empty(size, np.int64)
    place[order.to_numpy()] = np.arange(size)
    coded = pc.dictionary_encode(texts.flatten())
    at = np.repeat(place, np.asarray(pc.list_value_length(texts)))
    pairs, tf = np.unique(np.asarray(coded.indices).astype(np.int64) * size + at, return_counts=True)
    lengths = np.bincount(pairs // size, minlength=len(coded.dictionary))
    n, all_, places = len(lengths), np.append(lengths, len(pairs)), pairs % size
    only = lambda values: _array(values.type, np.append(0 * lengths, len(values)), values)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n + 1, seg), pa.int64()), pa.concat_arrays([coded.dictionary, pa.nulls(1, coded.dictionary.type)]),
         pa.array(np.arange(n + 1), pa.int32()), pa.array(np.append(lengths, size), pa.int32()), _array(pa.int16(), all_, np.tile(places, 2)),
         _array(pa.int32(), all_, np.tile(tf, 2)), only(pa.array(lengths, pa.int32())), *(only(rows[c].take(order).combine_chunks()) for c in ("doc", "key"))],
        ["seg", "term", "code", "n", "at", "tf", "lengths", "docs", "keys"])


def _segments(limit: int):
    """Map function: rows (doc, key, words) are cut into segments of ``limit`` words (a document is never divided)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, held, have, docs = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in batches:
            ends, first = np.cumsum(np.asarray(pc.list_value_length(batch.column("words")))), 0
            while first < batch.num_rows:
                before = ends[first - 1] if first else 0
                stop = min(int(np.searchsorted(ends, before + limit - have)) + 1, batch.num_rows, first + PLACES - docs)
                held.append(batch.slice(first, stop - first))
                first, have, docs = stop, have + int(ends[stop - 1] - before), docs + stop - first
                if have >= limit or docs == PLACES:
                    yield _segment_lists(seg, pa.Table.from_batches(held))
                    seg, held, have, docs = seg + 1, [], 0, 0
        if held:
            yield _segment_lists(seg, pa.Table.from_batches(held))
    return run


def _segment_vectors(heads: pa.Table, terms: pa.Table) -> pa.Table:
    """Cogroup function: a segment's row without a word, and its words with df -> its documents with their norms and words."""
    lengths, at, tf, docs, keys = (heads[c].combine_chunks().flatten() for c in ("lengths", "at", "tf", "docs", "keys"))
    terms, total = terms.sort_by("code").combine_chunks(), heads["total"][0].as_py()
    of, at, tf = np.repeat(np.arange(len(lengths)), lengths), at.to_numpy(), tf.to_numpy()
    idf = np.log((total + 1) / (terms["df"].to_numpy() + 1))[of]
    norm = np.sqrt(np.bincount(at, (tf * idf) ** 2, len(docs)))
    order = np.argsort(at, kind="stable")
    order = order[idf[order] > 0]
    of = pa.array(of[order])
    vec = pa.StructArray.from_arrays([terms["term"].combine_chunks().take(of), terms["df"].combine_chunks().take(of), pa.array(tf[order], pa.int32())], ["term", "df", "tf"])
    seg, total = (pa.array(np.full(len(docs), x), pa.int64()) for x in (heads["seg"][0].as_py(), total))
    return pa.table({"seg": seg, "n": pa.array(np.arange(len(docs)), pa.int32()), "doc": docs, "key": keys, "total": total, "norm": pa.array(norm),
                     "vec": _array(vec.type, np.bincount(at[order], minlength=len(docs)), vec)})


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None, folder: str | None = None) -> Index:
    """Index of ``docs``: ids must be unique. ``key_col``: a column that queries can be limited to a value of."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, f"index-{uuid.uuid4().hex}")
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("doc"), key.alias("key"), words(F.col(text_col)).alias("words"))
    kind = rows.schema["doc"].dataType.simpleString()
    lists = _stored(rows.mapInArrow(_segments(BLOCK), "seg long, term string, code int, n int, at array<smallint>, tf array<int>, lengths array<int>, "
                                    f"docs array<{kind}>, keys array<string>"), folder, "lists")
    heads, lists = lists.filter("term is null"), lists.filter("term is not null")
    n = heads.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    # a word's segments come along with its documents' number, to be told of it
    stored = _stored(lists.groupBy("term").agg(F.sum("n").alias("df"), F.collect_list(F.struct("seg", "code")).alias("places"))
                     .withColumn("idf", F.log((n + 1) / (F.col("df") + 1))), folder, "vocabulary")
    vocabulary = stored.select("term", "df", "idf")
    known = stored.select("term", "df", F.explode("places").alias("p")).select(F.col("p.seg").alias("of"), F.col("p.code").alias("code"), "term", "df")
    vectors = _stored(heads.select("seg", "lengths", "at", "tf", "docs", "keys", n.alias("total")).groupBy("seg").cogroup(known.groupBy("of")).applyInArrow(
        _segment_vectors, f"seg long, n int, doc {kind}, key string, total bigint, norm double, vec array<struct<term string, df bigint, tf int>>"),
                      folder, "vectors")
    idf = lambda t: F.log((F.col("total") + 1) / (t["df"] + 1))
    return Index(vocabulary, vectors.select("doc", "key", F.transform("vec", lambda t: F.struct(
        t["term"].alias("term"), t["df"].alias("df"), (t["tf"] * idf(t) / F.col("norm")).alias("w"))).alias("vec")),
        lists.select("seg", "term", "at", "tf"), vectors.select("seg", "n", "doc", "key", "norm"))


def _full_scores(pairs: DataFrame, index: Index, terms: DataFrame) -> DataFrame:
    """(query_id, doc) -> query_id, doc, score. Of the documents only the paired ones are opened, and of their words those that
    no query has are left out before the document meets its queries."""
    vec = index.vectors.join(pairs.select("doc"), "doc", "left_semi")
    # not explode(): Spark would weigh the words of all documents first, to drop those without any
    vec = vec.select("doc", F.explode_outer("vec").alias("t")).select("doc", F.col("t.term").alias("term"), F.col("t.w").alias("w"))
    vec = vec.join(terms.select("term").distinct(), "term", "left_semi")
    return (pairs.join(vec, "doc").join(terms.select("query_id", "term", "qw"), ["query_id", "term"])
            .groupBy("query_id", "doc").agg(F.sum(F.col("qw") * F.col("w")).alias("score")))


def _best(lists: dict, asked: list, size: int, own: np.ndarray, k: int, seeds: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the places ``own`` the k best (ties: the first) for one query, and their sums. lists: term -> places, weights, largest."""
    have = sorted(((a["qw"] * lists[a["term"]][2], a["qw"], a["term"]) for a in asked if a["term"] in lists), reverse=True)
    scores, k = np.zeros(size), min(k, len(own))
    rest, near, look = sum(most for most, *_ in have), None, seeds
    for i, (most, qw, term) in enumerate(have, 1):
        at, w, _ = lists[term]
        if near is None:
            scores[at] += qw * w
        else:
            spot = np.minimum(np.searchsorted(at, near), len(at) - 1)
            hit = at[spot] == near
            scores[near[hit]] += qw * w[spot[hit]]
        rest -= most
        if i == look < len(have):
            look, part = 2 * look, scores[own]
            reach = np.flatnonzero(part >= np.partition(part, -k)[-k] - rest - 2 * EPS)
            near = own[reach] if len(reach) <= len(part) // 8 else near
    part = np.round(scores[own], 9)
    least = np.partition(part, -k)[-k]
    above = np.flatnonzero(part > least)
    found = np.concatenate([above, np.flatnonzero(part == least)[:k - len(above)]])
    return own[found], part[found]


def _segment_search(k: int, seeds: int):
    """Cogroup function: a segment (its places, and its lists of words that queries have) and queries -> query_id, doc, score."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        docs, rows = rows.filter(pc.is_null(rows["term"])).sort_by("n"), rows.filter(pc.is_valid(rows["term"]))
        ids, norm, lists = docs["doc"].combine_chunks(), docs["norm"].to_numpy(), {}
        if not len(ids) or not queries.num_rows:
            return pa.table({"query_id": queries["query_id"].slice(0, 0), "doc": ids.slice(0, 0), "score": pa.array([], pa.float64())})
        for term, idf, at, tf in zip(rows["term"].to_pylist(), rows["idf"].to_pylist(), rows["at"], rows["tf"], strict=True):
            at = at.values.to_numpy().astype(np.intp)
            w = tf.values.to_numpy() * idf / norm[at]
            lists[term] = at, w, w.max()
        runs = pc.run_end_encode(docs["key"].combine_chunks())
        ends = runs.run_ends.to_pylist()
        own = {key: np.arange(lo, hi) for key, lo, hi in zip(runs.values.to_pylist(), [0, *ends[:-1]], ends, strict=True)}
        own[None] = pc.sort_indices(ids).to_numpy().astype(np.intp)
        found = [_best(lists, asked or [], len(ids), own[want], k, seeds) for want, asked in zip(queries["want"].to_pylist(), queries["words"].to_pylist(), strict=True)]
        return pa.table({"query_id": queries["query_id"].combine_chunks().take(pa.array(np.repeat(np.arange(len(found)), [len(p) for p, _ in found]))),
                         "doc": ids.take(pa.array(np.concatenate([p for p, _ in found]))), "score": pa.array(np.concatenate([s for _, s in found]))})
    return run


def search(index: Index, queries: DataFrame, k: int = 5, id_col: str = "query_id", text_col: str = "text", key_col: str | None = None,
           folder: str | None = None) -> DataFrame:
    """query_id, rank, doc, score: the k best documents for each query; with ``key_col``, of those with the query's key (a
    null key: of all)."""
    spark = queries.sparkSession
    folder = folder or scratch_path(spark, f"search-{uuid.uuid4().hex}")
    want = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    asked = _stored(queries.select(F.col(id_col).alias("query_id"), want.alias("want"), F.col(text_col).alias("text")).dropDuplicates(["query_id"]), folder, "asked")
    counts = _stored(_counts(asked, F.col("text"), F.col("query_id"), F.col("want")), folder, "counts")
    terms = counts.join(index.vocabulary.filter("idf > 0"), "term").select("query_id", "term", "idf", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("query_id")))
    terms = _stored(terms.select("query_id", "term", "idf", (F.col("w") / norm).alias("qw")), folder, "terms")

    # queries go to the segments that can have their documents; many queries are dealt over lots, which each meet the segment
    lots = asked.agg(F.greatest(F.ceil(F.count(F.lit(1)) / LOT), F.lit(1)).cast("int")).scalar()
    asks = (asked.select("query_id", "want", F.pmod(F.xxhash64("query_id"), lots).cast("int").alias("lot"))
            .join(terms.groupBy("query_id").agg(F.collect_list(F.struct("term", "qw")).alias("words")), "query_id", "left"))
    cols = ["seg", "lot", "query_id", "want", "words"]
    everywhere = index.places.select("seg").distinct().withColumn("one", F.lit(1))
    sent = asks.filter("want is null").withColumn("one", F.lit(1)).join(everywhere, "one").select(*cols)
    if key_col:
        sent = sent.unionByName(asks.join(index.places.select("seg", F.col("key").alias("want")).distinct(), "want").select(*cols))
    parts = (index.lists.join(terms.select("term", "idf").distinct(), "term")
             .unionByName(index.places.withColumns({c: F.array().cast(index.lists.schema[c].dataType) for c in ("at", "tf")}), allowMissingColumns=True)
             .withColumn("lot", F.explode(F.sequence(F.lit(0), lots - 1))))
    types = {f.name: f.dataType.simpleString() for f in [*asked.schema, *index.places.schema]}
    found = (parts.groupBy("seg", "lot").cogroup(sent.groupBy("seg", "lot"))
             .applyInArrow(_segment_search(k, SEEDS), f"query_id {types['query_id']}, doc {types['doc']}, score double"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc")
    best = _stored(found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "doc"), folder, "best")
    total = (best.join(_full_scores(best, index, terms), ["query_id", "doc"], "left")
             .select("query_id", "doc", F.round(F.coalesce("score", F.lit(0.0)), 9).alias("score")))
    return _stored(total.withColumn("rank", F.row_number().over(w)).select("query_id", "rank", "doc", "score"), folder, "hits")
