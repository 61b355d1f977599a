"""op5: every word before has a restaurant of its own, and the work is dealt out without changing the model."""

import math
import random

from pvspark.llm import pitman_yor
from test_llm_operators import frame


def test_contexts_are_whole_words(spark):
    """More contexts than any fixed number of hash classes, all with one ending: what follows depends on the whole word."""
    rows = [(i, " ".join(f"n{k}same v{(k * 7919) % 5000}same" for k in range(i % 50, 5000, 50))) for i in range(400)]
    got = pitman_yor.score(frame(spark, rows)).filter("held_out").collect()
    bits = -sum(r.score for r in got) / sum(r.n_tokens for r in got) / math.log10(2)
    assert got and bits < 4                                  # the next word is certain; by its ending, one of 5,000


def test_scores_do_not_depend_on_how_pairs_are_dealt(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{min(rng.randrange(400), rng.randrange(400))}" for _ in range(80))) for i in range(150)]
    whole = {r.doc_id: r.score for r in pitman_yor.score(frame(spark, rows)).collect()}
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 300)     # 41 chunks, stretches of 20 documents, many ranges of contexts
    monkeypatch.setattr(pitman_yor, "SLICE_ROWS", 20)
    monkeypatch.setattr(pitman_yor, "CONTEXTS", 500)
    monkeypatch.setattr(pitman_yor, "HOT", 1 / 150)          # the most frequent words lie in several chunks
    dealt = {r.doc_id: r.score for r in pitman_yor.score(frame(spark, rows)).collect()}
    assert whole.keys() == dealt.keys()
    assert sum(abs(whole[k] - dealt[k]) for k in whole) / len(whole) / 81 < 0.02      # seats are drawn anew
    assert abs(sum(whole.values()) - sum(dealt.values())) / len(whole) / 81 < 0.005
