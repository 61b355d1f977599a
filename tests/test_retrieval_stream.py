"""kNN against numpy brute force; streaming restart / dedup / quarantine properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY
from pvspark.operators import retrieve
from pvspark.sources.tables import read_table
from pvspark.streaming import ingest


def _brute(emb: pd.DataFrame, queries: pd.DataFrame, k: int, filtered: bool):
    C = np.stack(emb.embedding.to_numpy()).astype(np.float64)
    out = {}
    for _, q in queries.iterrows():
        d = ((C - np.asarray(q.embedding, dtype=np.float64)) ** 2).sum(1)
        ids = emb.vec_id.to_numpy()
        mask = (emb.label.to_numpy() == q.query_label) if filtered and q.query_label is not None else np.ones(len(ids), bool)
        order = np.lexsort((ids[mask], d[mask]))[:k]
        out[int(q.query_id)] = [int(x) for x in ids[mask][order]]
    return out


@pytest.mark.parametrize("filtered", [True, False])
def test_knn_matches_brute_force(spark, filtered):
    emb = read_table(spark, SF_TINY, "embeddings").repartition(5)
    q = emb.filter(F.col("vec_id") < 12).select(F.col("vec_id").alias("query_id"), "embedding",
                                               F.col("label").alias("query_label"))
    kw = {"filter_col": "label", "query_filter_col": "query_label"} if filtered else {}
    hits = retrieve.knn(emb, q, k=7, part=40, **kw)            # many parts a key
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == _brute(emb.toPandas(), q.toPandas(), 7, filtered)


def test_knn_ties_missing_filter_and_large_k(spark):
    corpus = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, -1.0], 2), (4, [5.0, 5.0], 2)],
                                   "vec_id long, embedding array<float>, label int")
    queries = spark.createDataFrame([(10, [0.0, 0.0], None), (11, [0.0, 0.0], 2)],
                                    "query_id long, embedding array<float>, query_label int")
    hits = retrieve.knn(corpus, queries, k=10, filter_col="label", query_filter_col="query_label")
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[10] == [1, 2, 3, 4]          # no filter value -> whole corpus; equal distances -> id order
    assert got[11] == [3, 4]                # k larger than the filtered corpus


def test_knn_string_ids_and_repeated_queries(spark):
    corpus = spark.createDataFrame([(f"PMC{i}", [float(i % 7), float(i % 5)], f"d{i % 2}") for i in range(60)] + [("none", None, "d1")],
                                   "vec_id string, embedding array<float>, label string")
    queries = spark.createDataFrame([("a", [1.0, 1.0], "d1"), ("a", [1.0, 1.0], "d1"), ("b", [0.0, 0.0], None)],
                                    "query_id string, embedding array<float>, want string")
    for part in (5, 10_000):
        hits = retrieve.knn(corpus, queries, k=4, filter_col="label", query_filter_col="want", part=part)
        got = {(r.query_id, r.rank): r.vec_id for r in hits.collect()}
        assert [got["a", r] for r in (1, 2, 3, 4)] == sorted(
            (f"PMC{i}" for i in range(60) if i % 2), key=lambda x: ((int(x[3:]) % 7 - 1) ** 2 + (int(x[3:]) % 5 - 1) ** 2, x))[:4]
        assert got["b", 1] == "PMC0" and len(got) == 8
    assert retrieve.knn(corpus.limit(0), queries, k=4).count() == 0 and retrieve.knn(corpus, queries.limit(0), k=4).count() == 0


def test_digest_context_takes_any_id(spark):
    articles = spark.createDataFrame([("PMC1", "t1", "alpha beta", "A", 2000), ("PMC2", "t2", "gamma delta", "A", None)],
                                     "article_id string, title string, abstract string, drug_name string, publish_year int")
    profiles = spark.createDataFrame([("p", "A", "18-34", "LOW"), ("q", "Z", "18-34", "LOW")],
                                     "profile_id string, drug_name string, age_group string, risk_label string")
    got = {r.profile_id: r.text for r in retrieve.digest_context(profiles, articles).collect()}
    assert "[PMC1] t1 (2000):" in got["p"] and "[PMC2] t2 (0):" in got["p"]
    assert got["q"] == "No relevant research found for Z."


def test_research_list_empty_result(spark):
    hits = spark.createDataFrame([("a", 1, "7", "t", 1999, "x" * 400)], "query_id string, rank int, article_id string, title string, publish_year int, abstract string")
    asked = spark.createDataFrame([("a", "A"), ("b", "B")], "query_id string, name string")
    got = {r.query_id: r.text for r in retrieve.research_list_text(hits, asked=asked).collect()}
    assert got == {"a": "- [7] t (1999): " + "x" * 300, "b": "No relevant research papers found for B."}


def test_cells_equal_brute_force_and_skip_cells(spark, tmp_dir):
    from pvspark.operators import cells
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 20, (12, 6))
    rows = [(f"v{i:04d}", [float(x) for x in middles[i % 12] + rng.normal(0, 1, 6)], "ab"[i % 2]) for i in range(600)]
    rows += [("same1", rows[0][1], "a"), ("same0", rows[0][1], "a"), ("null", None, "a"), ("nokey", rows[5][1], None)]
    corpus = spark.createDataFrame(rows, "vec_id string, embedding array<double>, grp string")
    asked = [(i, rows[i * 7][1], ("a", None, "b", "none")[i % 4]) for i in range(16)] + [(99, None, "a")]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>, want string")
    built = cells.build(corpus, f"{tmp_dir}/cells", cells=12, key_col="grp")
    got, read = cells.search(built, queries, k=4, query_key_col="want", part=16)
    want = []
    for q, v, g in asked:
        if v is not None:
            near = sorted((float(((np.array(x) - np.array(v)) ** 2).sum()), i) for i, x, grp in rows if x is not None and g in (None, grp))[:4]
            want += [(q, n + 1, i) for n, (_, i) in enumerate(near)]
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got.collect()) == sorted(want)
    assert read.filter("query_id % 4 = 1").count() < 4 * 12                       # unfiltered queries skip cells
    near, _ = cells.search(built, queries, k=4, query_key_col="want", probes=1)
    assert {r.query_id for r in near.collect()} <= {q for q, *_ in asked}
    empty = cells.build(corpus.limit(0), f"{tmp_dir}/none", cells=3)
    assert cells.search(empty, queries, k=2)[0].collect() == []


def test_index_prunes_and_equals_brute_force(spark, monkeypatch):
    """Small blocks and few seeds, so that salts, levels and bounds all matter."""
    import math
    import random
    import re

    from pvspark.operators import index
    monkeypatch.setattr(index, "BLOCK", 4)
    monkeypatch.setattr(index, "SEEDS", 1)
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(40)] + ["é中", "the", "the", "the"]
    docs = [(f"d{i:03d}", " ".join(rng.choices(vocab, k=rng.randrange(1, 30))) + " The", rng.choice("ab")) for i in range(150)]
    docs += [("e1", None, "a"), ("e2", " ,; ", "b"), ("e3", "only here", None)]
    asked = [("q1", "w1 w2, W3 the é中", None), ("q2", "w5 w5 w7", "a"), ("q3", "unknown words", None), ("q4", None, "b"), ("q5", "w9", "zz"), ("q6", "here", None)]
    built = index.build(spark.createDataFrame(docs, "id string, text string, grp string"), "id", "text", "grp")
    got = index.search(built, spark.createDataFrame(asked, "q string, text string, want string"), 7, "q", "text", "want").collect()

    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    tf = {i: {w: split(t).count(w) for w in split(t)} for i, t, _ in docs}
    idf = {w: math.log((len(docs) + 1) / (sum(w in v for v in tf.values()) + 1)) for v in tf.values() for w in v}

    def vec(counts):
        v = {w: n * idf[w] for w, n in counts.items() if idf.get(w, 0) > 0}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vecs, want = {i: vec(v) for i, v in tf.items()}, []
    for q, t, g in asked:
        v = vec({w: split(t).count(w) for w in split(t)})
        scored = sorted((-round(sum(x * vecs[i].get(w, 0) for w, x in v.items()), 9), i) for i, _, grp in docs if g is None or grp == g)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:7])]
    assert sorted((r.query_id, r.rank, r.doc) for r in got) == sorted(w[:3] for w in want)
    assert all(abs(r.score - dict(((a, b), d) for a, b, _, d in want)[r.query_id, r.rank]) < 1e-8 for r in got)


def test_index_without_rows(spark):
    from pvspark.operators import index
    built = index.build(spark.createDataFrame([], "doc_id long, text string"))
    assert index.search(built, spark.createDataFrame([(1, "a")], "query_id long, text string")).collect() == []


def _write_lines(path, lines):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-{len(os.listdir(path)):03d}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_quarantine_dedup_and_restart(spark, tmp_dir):
    good = '{"post_id":"%s","subreddit":"s","title":"t","body":"b %s","score":1,"created_utc":"2024-01-01T00:00:0%d+00:00"}'
    src = f"{tmp_dir}/in"
    _write_lines(src, [good % ("a", "x", 1), good % ("a", "y", 2), "nope", "[1]",
                       '{"post_id":"b","body":"","created_utc":"2024-01-01T00:00:00+00:00"}',
                       '{"post_id":"c","body":"z"}', '{"body":"q","created_utc":"2024-01-01T00:00:00+00:00"}'])
    _write_lines(src, [good % ("a", "again", 3), good % ("d", "x", 4)])

    def run():
        ingest.start_ingest(spark, f"{tmp_dir}/out", f"{tmp_dir}/ck", source="files", path=src, max_per_trigger=1,
                            trigger={"availableNow": True}, quality_out=f"{tmp_dir}/q").awaitTermination()
        d = ingest.dedup_stream(ingest.decode_messages(ingest.read_messages(spark, "files", src, max_per_trigger=1)),
                                "1 day").select("post_id")
        ingest.write_append(d, f"{tmp_dir}/dd", f"{tmp_dir}/ckd").awaitTermination()

    run()
    out = ingest.read_batches(spark, f"{tmp_dir}/out")
    reasons = sorted(r.reject_reason for r in out.filter("not is_valid").collect())
    assert reasons == ["body is null or empty", "could not decode message", "could not decode message",
                       "created_utc is null", "post_id is null"]
    assert out.filter("is_valid").count() == 4
    q = spark.read.parquet(f"{tmp_dir}/q")
    assert q.count() == 16                                  # 8 posts checks x 2 micro-batches
    assert {r.check_name for r in q.filter("not success").collect()} >= {"unique", "in_set"}
    assert sorted(r.post_id for r in spark.read.parquet(f"{tmp_dir}/dd").collect()) == ["a", "d"]
    before = (out.count(), spark.read.parquet(f"{tmp_dir}/dd").count())
    run()                                                         # restart from the checkpoint: nothing new
    after = (ingest.read_batches(spark, f"{tmp_dir}/out").count(), spark.read.parquet(f"{tmp_dir}/dd").count())
    assert before == after


def test_invalid_utf8_bytes_rejected(spark):
    df = spark.createDataFrame([(bytearray(b'{"post_id":"1","body":"x","created_utc":"2024-01-01T00:00:00+00:00"}'),),
                                (bytearray(b"\xff\xfe{"),)], "value binary")
    got = [r.reject_reason for r in ingest.decode_messages(df).collect()]
    assert got == [None, "could not decode message"]


def test_batches_close_by_size_or_idle_and_survive_a_stop(spark, tmp_dir):
    from pyspark.sql import functions as F

    from pvspark.streaming import batches
    src, lane = f"{tmp_dir}/in", F.col("value").cast("long") % 2
    _write_lines(src, [str(i) for i in range(25)])
    stream = spark.readStream.format("text").load(src)
    batches.run_until_quiet(stream, lane, f"{tmp_dir}/out", f"{tmp_dir}/ck", size=5, idle_seconds=3600, quiet=2)
    assert sorted((r.lane, r.batch) for r in spark.read.schema(batches.BATCH).parquet(f"{tmp_dir}/out").collect()) == [
        ("0", 0), ("0", 1), ("1", 0), ("1", 1)]                                    # 3 and 2 messages wait
    _write_lines(src, [str(i) for i in range(25, 34)])
    batches.run_until_quiet(stream, lane, f"{tmp_dir}/out", f"{tmp_dir}/ck", size=5, idle_seconds=1)
    rows = spark.read.schema(batches.BATCH).parquet(f"{tmp_dir}/out").collect()
    assert sorted(int(v) for r in rows for v in r["values"]) == list(range(34))
    assert all(len(r["values"]) == 5 if r.closed_by == "size" else 0 < len(r["values"]) < 5 for r in rows)
    assert sorted(r.lane for r in rows if r.closed_by == "idle") == ["0", "1"]
