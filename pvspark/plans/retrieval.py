"""Build step 7: exact kNN (filtered / unfiltered), upsert, context assembly, TF-IDF retrieval."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pvspark.operators import cells, index, retrieve
from pvspark.operators.dedup import create_buckets, upsert_buckets, upsert_latest
from pvspark.plans import oracle_ctes as O
from pvspark.plans.base import r6, register
from pvspark.plans.layers import silver_articles_df
from pvspark.session import scratch_path
from pvspark.sources.tables import read_table

def _queries(emb):
    """Queries derived from the corpus: the centroid of each label (query_id = label)."""
    c = retrieve.centroids(emb, "label")
    return c.select(F.col("label").cast("long").alias("query_id"), "embedding", F.col("label").alias("query_label"))


def _knn_sql(filtered: bool) -> str:
    cond = "ON c.label = q.ql" if filtered else "ON TRUE"
    return f"""
WITH ev AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
px AS (SELECT label, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM ev),
pm AS (SELECT label, i, avg(x) AS m FROM px GROUP BY label, i),
q AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS qe, label AS ql FROM pm GROUP BY label),
c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS ce, label FROM embeddings),
d AS (SELECT q.query_id, c.vec_id,
             list_sum(list_transform(range(1, len(q.qe) + 1), lambda i: (q.qe[i] - c.ce[i]) * (q.qe[i] - c.ce[i]))) AS distance
      FROM q JOIN c {cond}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5"""


@register("knn_filtered", _knn_sql(True))
def q_knn_filtered(spark, sf_dir):
    """R4 / T4 with the equality filter (label of the query)."""
    emb = read_table(spark, sf_dir, "embeddings")
    hits = retrieve.knn(emb, _queries(emb), k=5, filter_col="label", query_filter_col="query_label")
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", r6("distance").alias("distance"))


@register("knn_all", _knn_sql(False))
def q_knn_all(spark, sf_dir):
    """R4 / T4 without a filter: every corpus vector is a candidate."""
    emb = read_table(spark, sf_dir, "embeddings")
    hits = retrieve.knn(emb, _queries(emb), k=5)
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", r6("distance").alias("distance"))


def _cells(spark, sf_dir, key_col=None):
    emb = read_table(spark, sf_dir, "embeddings")
    return cells.build(emb, scratch_path(spark, f"vectors-{uuid.uuid4().hex}"), key_col=key_col), emb


def _hit_columns(hits):
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", r6("distance").alias("distance"))


@register("knn_cells", _knn_sql(False))
def q_knn_cells(spark, sf_dir):
    """R4 / T4 over k-means cells, exact: the rows of ``knn_all``, from the cells that can hold them."""
    built, emb = _cells(spark, sf_dir)
    return _hit_columns(cells.search(built, _queries(emb), k=5)[0])


@register("knn_cells_filtered", _knn_sql(True))
def q_knn_cells_filtered(spark, sf_dir):
    """R4 / T4 over k-means cells with the equality filter."""
    built, emb = _cells(spark, sf_dir, "label")
    return _hit_columns(cells.search(built, _queries(emb), k=5, query_key_col="query_label")[0])


@register("knn_probe_recall")
def q_knn_probe_recall(spark, sf_dir):
    """R4, approximate: every 100th vector asks for its 10 nearest among the CELLS / 4 nearest cells; recall against the
    exact search and the share of (query, cell) pairs that each reads (rows-only check: k-means)."""
    built, emb = _cells(spark, sf_dir)
    q = emb.filter(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    exact, read = cells.search(built, q, k=10)
    some, probed = cells.search(built, q, k=10, probes=cells.CELLS // 4)
    hit = exact.join(some, ["query_id", "vec_id"], "left_semi")
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    pairs = n(q) * n(built.stats)
    return spark.range(1).select((n(hit) / n(exact)).alias("recall"), (n(read) / pairs).alias("cells_read_exact"),
                                 (n(probed) / pairs).alias("cells_read_probes"))


@register("upsert_latest", """
WITH u AS (SELECT vec_id, label, 1 AS version FROM embeddings
           UNION ALL SELECT vec_id, label + 100, 2 FROM embeddings WHERE embedding[1] > 0)
SELECT vec_id, label, version FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY version DESC, label) AS rn FROM u) WHERE rn = 1""")
def q_upsert_latest(spark, sf_dir):
    """The whole vector table (version 1) upserted with an update batch - every vector
    whose first component is positive, re-labelled (version 2); the newer version of an id wins."""
    emb = read_table(spark, sf_dir, "embeddings")
    old = emb.select("vec_id", "embedding", "label", F.lit(1).alias("version"))
    new = emb.filter(F.get("embedding", 0) > 0).select("vec_id", "embedding", (F.col("label") + 100).alias("label"),
                                                       F.lit(2).alias("version"))
    return upsert_latest(old, new, "vec_id", "version").select("vec_id", "label", "version")


@register("upsert_buckets", """
WITH u AS (SELECT vec_id, label, 1 AS version FROM embeddings
           UNION ALL SELECT vec_id, label + 100, 2 FROM embeddings WHERE embedding[1] > 0
           UNION ALL SELECT -1 - vec_id, label, 1 FROM embeddings WHERE embedding[1] > 0)
SELECT vec_id, label, version FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY version DESC, label) AS rn FROM u) WHERE rn = 1""")
def q_upsert_buckets(spark, sf_dir):
    """K8 / R3 on a stored table partitioned by id bucket: newer versions and new ids, only touched buckets rewritten."""
    path = scratch_path(spark, f"vectors-{uuid.uuid4().hex}")
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label", F.lit(1).alias("version"))
    create_buckets(emb, path, "vec_id")
    some = emb.filter(F.get("embedding", 0) > 0)
    upsert_buckets(path, some.withColumns({"label": F.col("label") + 100, "version": F.lit(2)}), "vec_id", "version")
    upsert_buckets(path, some.withColumn("vec_id", -1 - F.col("vec_id")), "vec_id", "version")
    return spark.read.schema("vec_id long, label int, version int").parquet(path).select("vec_id", "label", "version")


def _context_sql() -> str:
    knn = _knn_sql(True).strip()
    knn = knn[len("WITH "):knn.rindex("SELECT query_id, CAST(rank")].rstrip()
    return (O.with_layers(["articles_raw"], O.SILVER_ARTICLES) + ",\n" + knn + """
SELECT r.query_id, string_agg('[' || a.article_id || '] ' || a.title || ' (' || CAST(coalesce(a.publish_year, 0) AS VARCHAR)
                              || '):' || chr(10) || substr(a.abstract, 1, 1000), chr(10) || chr(10) ORDER BY r.rank) AS text
FROM r JOIN silver_articles a ON a.article_id = CAST(r.vec_id AS VARCHAR)
WHERE r.rank <= 5
GROUP BY r.query_id""")


@register("context_text", _context_sql())
def q_context_text(spark, sf_dir):
    """R1 + R6 + A12 / X2: filtered kNN hits joined to the article corpus, ranked context text."""
    emb = read_table(spark, sf_dir, "embeddings")
    hits = retrieve.knn(emb, _queries(emb), k=5, filter_col="label", query_filter_col="query_label")
    corpus = retrieve.prepare_corpus(silver_articles_df(spark, sf_dir))
    j = hits.join(corpus, corpus["article_id"] == hits["vec_id"].cast("string"), "inner")
    return retrieve.context_text(j)


TFIDF_SQL = """
n AS (SELECT count(*) AS n FROM c),
cw AS (SELECT id, key, term, count(*) AS tf FROM (SELECT id, key, unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+')) AS term FROM c)
       WHERE term <> '' GROUP BY id, key, term),
v AS (SELECT term, ln((n.n + 1) / (count(*) + 1)) AS idf FROM cw, n GROUP BY term, n.n),
dw AS (SELECT id, key, term, tf * idf AS w, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)) AS norm FROM cw JOIN v USING (term)),
qw AS (SELECT query_id, want, term, tf * idf AS w, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY query_id)) AS norm
       FROM (SELECT query_id, want, term, count(*) AS tf FROM (
               SELECT query_id, want, unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+')) AS term FROM q)
             WHERE term <> '' GROUP BY query_id, want, term) JOIN v USING (term)),
hit AS (SELECT query_id, id, sum(qw.w * dw.w / qw.norm / dw.norm) AS score FROM qw JOIN dw USING (term)
        WHERE qw.w > 0 AND dw.w > 0 AND (want IS NULL OR want = key) GROUP BY query_id, id),
full_ AS (SELECT q.query_id, c.id, round(coalesce(score, 0.0), 9) AS score FROM q JOIN c ON want IS NULL OR want = key
          LEFT JOIN hit ON hit.query_id = q.query_id AND hit.id = c.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM full_)"""


@register("tfidf_knn", f"""
WITH c AS (SELECT doc_id AS id, NULL::VARCHAR AS key, text FROM documents),
q AS (SELECT item_id AS query_id, NULL::VARCHAR AS want, text FROM benchmark), {TFIDF_SQL}
SELECT query_id, CAST(rank AS INTEGER) AS rank, id AS doc_id, round(score, 6) AS similarity FROM r WHERE rank <= 5""")
def q_tfidf_knn(spark, sf_dir):
    """R2 + R4: TF-IDF vectors of every document over the whole vocabulary; each benchmark passage retrieves its 5 nearest
    documents from the inverted index."""
    built = index.build(read_table(spark, sf_dir, "documents"))
    hits = index.search(built, read_table(spark, sf_dir, "benchmark"), k=5, id_col="item_id")
    return hits.select("query_id", "rank", F.col("doc").alias("doc_id"), r6("score").alias("similarity"))


def _list_sql() -> str:
    knn = _knn_sql(True).strip()
    knn = knn[len("WITH "):knn.rindex("SELECT query_id, CAST(rank")].rstrip()
    return (O.with_layers(["articles_raw"], O.SILVER_ARTICLES) + ",\n" + knn + """
SELECT r.query_id, string_agg('- [' || a.article_id || '] ' || a.title || ' (' || CAST(coalesce(a.publish_year, 0) AS VARCHAR)
                              || '): ' || substr(a.abstract, 1, 300), chr(10) ORDER BY r.rank) AS text
FROM r JOIN silver_articles a ON a.article_id = CAST(r.vec_id AS VARCHAR)
WHERE r.rank <= 5
GROUP BY r.query_id""")


@register("research_list", _list_sql())
def q_research_list(spark, sf_dir):
    """R6 list form: ranked hits as ``- [id] title (year): abstract[:300]`` lines."""
    emb = read_table(spark, sf_dir, "embeddings")
    hits = retrieve.knn(emb, _queries(emb), k=5, filter_col="label", query_filter_col="query_label")
    corpus = retrieve.prepare_corpus(silver_articles_df(spark, sf_dir))
    j = hits.join(corpus, corpus["article_id"] == hits["vec_id"].cast("string"), "inner")
    return retrieve.research_list_text(j)
