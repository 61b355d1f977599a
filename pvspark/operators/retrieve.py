"""Retrieval (R1-R7, T4, X2): corpus prep, exact filtered kNN, context assembly. TF-IDF search is in ``index``.

Exact kNN plan
--------------
One path for any number of queries, any id type and any filter. The corpus is dealt out by (filter
key, part): a key with n vectors has ceil(n / PART) parts, so a key that holds a third of the corpus
is many small parts and an unfiltered search is the same thing with one key. Queries are joined to the
parts of their key (a query without a filter value goes to all of them) and meet their vectors in a
cogroup: one part and its queries are multiplied as matrices, only near candidates are recomputed
exactly, and ``k`` rows a query leave the part. A final ``row_number() <= k`` ranks those. Nothing is
collected to the driver, and no (query, vector) pair table exists.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 20_000               # vectors of a part
QUERY_BLOCK = 512           # queries multiplied with a part at once


def prepare_corpus(articles: DataFrame) -> DataFrame:
    """Drop rows without id / abstract or with an empty abstract; year NULL -> 0; NULL
    metadata text -> ''."""
    return (articles.filter(F.col("article_id").isNotNull() & F.col("abstract").isNotNull()
                            & (F.length("abstract") > 0))
            .withColumn("publish_year", F.coalesce(F.col("publish_year").cast("int"), F.lit(0)))
            .withColumn("title", F.coalesce("title", F.lit("")))
            .withColumn("drug_name", F.coalesce("drug_name", F.lit(""))))


def nearest(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the k nearest rows (by exact squared L2 distance, then id): positions and distances.

    A matrix product ranks all rows; those within rounding error of the k-th are recomputed exactly.
    """
    norms = np.einsum("nd,nd->n", vectors, vectors)
    out = []
    for at in range(0, len(queries), QUERY_BLOCK):
        block = queries[at:at + QUERY_BLOCK]
        rough = norms[None, :] - 2.0 * (block @ vectors.T) + np.einsum("qd,qd->q", block, block)[:, None]
        for q, d in zip(block, rough, strict=True):
            if len(d) > k:
                limit = np.partition(d, k - 1)[k - 1]
                near = np.flatnonzero(d <= limit + 1e-9 * (1.0 + norms.max() + q @ q))
            else:
                near = np.arange(len(d))
            diff = vectors[near] - q
            exact = np.einsum("nd,nd->n", diff, diff)
            order = np.lexsort((ids[near], exact))[:k]
            out.append((near[order], exact[order]))
    return out


def part_search(k: int):
    """Cogroup function: a part's vectors (vec_id, v) and its queries (query_id, q) -> query_id, vec_id, distance."""
    def search(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if c.empty or q.empty:
            return pd.DataFrame({"query_id": q["query_id"][:0], "vec_id": c["vec_id"][:0], "distance": np.zeros(0)})
        vectors = np.stack(c["v"].to_numpy()).astype(np.float64)
        ids = c["vec_id"].to_numpy()
        found = nearest(vectors, ids, np.stack(q["q"].to_numpy()).astype(np.float64), k)
        return pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(), [len(p) for p, _ in found]),
                             "vec_id": ids[np.concatenate([p for p, _ in found])],
                             "distance": np.concatenate([d for _, d in found])})
    return search


def knn(corpus: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
        query_id_col: str = "query_id", query_vec_col: str = "embedding", filter_col: str | None = None,
        query_filter_col: str | None = None, part: int = PART) -> DataFrame:
    """Exact k nearest corpus rows per query by squared L2 distance (the vector store's
    default metric), optionally restricted to corpus rows whose ``filter_col`` equals the query's
    ``query_filter_col`` (a NULL query value means no filter). Ties break on the smaller id.
    Returns (query_id, rank, vec_id, distance, similarity = 1 - distance). Ids keep their type; rows
    that repeat a query id are one query and must have the same vector; NULL vectors never match."""
    filtered = bool(filter_col and query_filter_col)
    key = F.col(filter_col).cast("string") if filtered else F.lit("")
    rows = corpus.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"), key.alias("key")).filter("v is not null")
    parts = (rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts")))
    dealt = (rows.join(parts.withColumnRenamed("key", "part_key"), F.col("key").eqNullSafe(F.col("part_key")))
             .select("vec_id", "v", "key", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part")))
    asked = (queries.select(F.col(query_id_col).alias("query_id"), F.col(query_vec_col).alias("q"),
                            (F.col(query_filter_col).cast("string") if filtered else F.lit(None).cast("string")).alias("want"))
             .filter("q is not null").dropDuplicates(["query_id"]))
    slots = parts.select(F.col("key").alias("slot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("n"))
    some = asked.filter("want is not null").join(slots, F.col("want") == F.col("slot"))
    every = asked.filter("want is null").withColumn("one", F.lit(1)).join(slots.withColumn("one", F.lit(1)), "one")
    sent = some.select("query_id", "q", "slot", "n").unionByName(every.select("query_id", "q", "slot", "n"))

    types = {f.name: f.dataType.simpleString() for f in [*asked.schema, *rows.schema]}
    cand = (dealt.groupBy("key", "part").cogroup(sent.groupBy("slot", "n"))
            .applyInPandas(part_search(k), f"query_id {types['query_id']}, vec_id {types['vec_id']}, distance double"))
    w = Window.partitionBy("query_id").orderBy(F.col("distance").asc(), F.col("vec_id").asc())
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "distance", (F.lit(1.0) - F.col("distance")).alias("similarity")))


def centroids(corpus: DataFrame, key: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per key (e.g. one query per label), as one vector aggregate. Output: (key, embedding)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = corpus.groupBy(key).agg(Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>"))).alias("_m"))
    return mean.select(key, vector_to_array("_m").alias(vec_col))


def profile_query(drug: Column, age_group: Column, risk: Column) -> Column:
    """The profile query text."""
    return F.format_string("%s adverse effects %s patients %s risk", drug, age_group, risk)


def context_text(hits: DataFrame, key: str = "query_id", clip: int = 1000, sep: str = "\n\n") -> DataFrame:
    """Per key, hits ordered by rank as ``[id] title (year):\\nabstract[:clip]`` joined by
    ``sep``. The list per key is bounded by k."""
    line = F.format_string("[%s] %s (%s):\n%s", F.col("article_id"), F.col("title"),
                           F.col("publish_year").cast("string"), F.substring("abstract", 1, clip))
    agg = hits.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("_l"))
    return agg.select(key, F.array_join(F.transform("_l", lambda s: s["line"]), sep).alias("text"))


def digest_context(profiles: DataFrame, articles: DataFrame, k: int = 5, clip: int = 1000) -> DataFrame:
    """Per profile (profile_id, drug_name, age_group, risk_label) the research
    context that would be handed to the language model: the profile query text is looked up in the TF-IDF index of
    the article abstracts, the k nearest abstracts OF THAT DRUG are retrieved, and formatted; no hit -> "No relevant
    research found for <drug>."."""
    from pvspark.operators import index

    corpus = prepare_corpus(articles)
    built = index.build(corpus, "article_id", "abstract", "drug_name")
    q = profiles.withColumn("text", profile_query(F.col("drug_name"), F.col("age_group"), F.col("risk_label")))
    hits = index.search(built, q, k, "profile_id", "text", "drug_name")
    meta = corpus.select("article_id", "title", "publish_year", "abstract")
    ctx = context_text(hits.join(meta, hits["doc"] == meta["article_id"]), key="query_id", clip=clip)
    out = profiles.join(ctx.withColumnRenamed("query_id", "profile_id"), "profile_id", "left")
    none = F.format_string("No relevant research found for %s.", F.col("drug_name"))
    return out.select("profile_id", "drug_name", F.coalesce(F.col("text"), none).alias("text"))


def research_list_text(hits: DataFrame, key: str = "query_id", clip: int = 300,
                       asked: DataFrame | None = None) -> DataFrame:
    """R6 list form: ``- [id] title (year): abstract[:clip]`` lines. With ``asked`` (key, name) every asked key has
    a row; one without a hit says "No relevant research papers found for <name>."."""
    line = F.format_string("- [%s] %s (%s): %s", F.col("article_id"), F.col("title"),
                           F.col("publish_year").cast("string"), F.substring("abstract", 1, clip))
    agg = hits.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("_l"))
    text = agg.select(key, F.array_join(F.transform("_l", lambda s: s["line"]), "\n").alias("text"))
    if asked is None:
        return text
    none = F.format_string("No relevant research papers found for %s.", F.col("name"))
    return asked.join(text, key, "left").select(key, F.coalesce("text", none).alias("text"))
