"""Operators 11 to 13 against plain Python on small tables: nulls, empty texts, ties, repeated rows, clashing columns, no rows."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pvspark.llm import merkle_manifest, pivotal_mix, prefix_trie

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank string, n string, size string, h string, part string"


def docs(spark, rows):
    """rows of (doc_id, text, lang, source, n_chars)"""
    return spark.createDataFrame([(*r, "rank", "n", "size", "h", "part") for r in rows], DOCS)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- 11 mixing ---------------------------------------------------------------------------------------

def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        t = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if t[s] > cap * sizes[s]]
        if not over:
            return {**t, **capped}
        capped |= {s: cap * sizes[s] for s in over}


def mix_rows(rng, n=900):
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), "en", rng.choice(["a", "a", "a", "b", "é", "中", None]), None) for i in range(n)]
    rows += [(10_000 + i, "x" * i, "en", "tiny", None) for i in range(3)] + [(20_000, "big " * 5000, "en", "b", None)]
    return rows + [(None, "no id", "en", "b", None)] * 40 + [(7, None, "en", "nothing", None), (8, " \t\n", "en", "nothing", None)]


def test_mix_reaches_targets_and_settles_every_document(spark):
    rows = mix_rows(random.Random(1))
    got = pivotal_mix.per_row(pivotal_mix.mix(docs(spark, rows))).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    size = {(i, s): len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, s, _ in rows}
    sizes = collections.Counter()
    for i, t, _, s, _ in rows:
        sizes[s] += size[i, s]
    want = brute_targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.size == size[r.doc_id, r.source] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        ratio = r.target / r.source_size if r.source_size else 0
        assert r.taken == r.copies * r.size and r.copies in (int(ratio), int(ratio) + (ratio > int(ratio))) and r.copies <= 3
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] + 1
        if sizes[s] > 5000:                       # what is left at the end is a small document
            assert abs(taken[s] - t) <= 0.02 * t


def test_mix_reruns_agree_and_ignores_partitions(spark):
    rows = mix_rows(random.Random(2), 400)
    df = docs(spark, rows)
    runs = [sorted(map(tuple, pivotal_mix.per_row(pivotal_mix.mix(df.repartition(n))).select("doc_id", "size", "taken").collect()), key=str)
            for n in (1, 7)]
    assert runs[0] == runs[1]


def test_mix_takes_each_document_in_proportion(spark):
    """The expectation of every document, large ones included, over many draws."""
    rng = random.Random(4)
    sizes = [rng.choice([3, 8, 20, 200, 900]) for _ in range(60)]
    rows = [(100 * k + i, "w " * n, "en", f"s{k}", None) for k in range(60) for i, n in enumerate(sizes)]
    got = pivotal_mix.per_row(pivotal_mix.mix(docs(spark, rows), weights=(1,), cap=3).withColumn("k", F.col("k"))).collect()
    assert all(r.copies == 1 for r in got)                                    # equal weights: each source as it is
    got = pivotal_mix.per_row(pivotal_mix.mix(docs(spark, rows), weights=(1, 3))).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.target < r.source_size, r.size].append(r.copies)
    for (few, _), c in by.items():
        assert sum(c) / len(c) == pytest.approx(0.5 if few else 1.5, abs=0.12)


def test_mix_repeats_texts(spark):
    rows = mix_rows(random.Random(3), 200)
    df = docs(spark, rows)
    plan = pivotal_mix.per_row(pivotal_mix.mix(df)).groupBy("doc_id").agg(F.sum("copies").alias("c")).collect()
    got = collections.Counter(r.doc_id for r in pivotal_mix.mixed(df).collect())
    assert {r.doc_id: r.c for r in plan if r.c} == dict(got)
    assert pivotal_mix.mixed(df).columns == df.columns


def test_mix_counts_repeated_rows_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(pivotal_mix, "CHUNK", 100)
    rows = [(1, "one two", "en", "a", None)] * 1050 + [(i, "w " * 9, "en", "b", None) for i in range(2, 60)]
    got = pivotal_mix.per_row(pivotal_mix.mix(docs(spark, rows))).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    assert len({r.copies for r in got if r.doc_id == 1}) <= 2


def test_mix_without_rows_or_words(spark):
    assert pivotal_mix.per_row(pivotal_mix.mix(docs(spark, []))).collect() == []
    got = pivotal_mix.per_row(pivotal_mix.mix(docs(spark, [(1, None, None, None, None), (2, "", None, "s", 3)]))).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


# ---- 12 Merkle manifest ------------------------------------------------------------------------------

def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, add=0):
        i, t, lang, source, n = r
        return sha("".join(map(field, (i, source, lang, None if n is None else n + add, t))))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            h = levels[-1]
            levels.append([sha("".join(h[i:i + 2])) for i in range(0, len(h), 2)])
        return levels

    def path(levels, i):
        out = []
        for h in levels[:-1]:
            j = i ^ 1
            out.append((j < i, h[j] if j < len(h) else None))
            i >>= 1
        return out

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, k)
            cur = leaf(r, 1 if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else 0)
            for left, s in steps:
                cur = sha(cur if s is None else s + cur if left else cur + s)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], "".join(s or "" for _, s in steps), cur, cur == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(rng, n):
    rows = [(i, f"text {i} é\n" * rng.randrange(3), rng.choice(["en", "en", "en", "de", "ζ", None]), rng.choice(["s", None, ""]),
             rng.choice([None, 5, -1])) for i in range(n)]
    return rows + [(None, None, None, None, None), (None, "x", "en", "s", 1), (3, "other", "en", "s", 1), (3, "other", "en", "s", 1),
                   (n + 1, "alone", "zz", "s", (1 << 63) - 1 if zlib.crc32(str(n + 1).encode()) % 7 else 0)]


@pytest.mark.parametrize("levels", [10, 2, 1])
def test_manifest_equals_brute_force(spark, levels):
    """Superblocks of 2 and 4 leaves need many tiers, in the groups and among them."""
    rows = manifest_rows(random.Random(levels), 61 if levels < 10 else 150)
    got = [(r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.proof.hex(), r.folded_root.hex(), r.verified)
           for r in merkle_manifest.manifest(docs(spark, rows), levels=levels).collect()]
    assert sorted(got, key=str) == brute_manifest(rows)
    assert levels == 1 or {r[6] for r in got} == {True, False}


def test_manifest_small_tables(spark):
    assert merkle_manifest.manifest(docs(spark, [])).collect() == []
    one = merkle_manifest.manifest(docs(spark, [(5, "a", "en", "s", 1)])).collect()[0]
    assert one.leaf == one.subroot == one.root and one.proof == b"" and one.verified == (zlib.crc32(b"5") % 7 != 0)


def test_manifest_paths_prove_membership(spark):
    rows = manifest_rows(random.Random(9), 80)
    for r in merkle_manifest.manifest(docs(spark, rows)).collect():
        assert merkle_manifest.fold(r.leaf, r.path) == r.root


# ---- 13 prefix trie ----------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, m string, n string, sid string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "m", "n", "sid") for r in rows], TURNS)


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        own[c].append(((t is not None, t or 0, role or ""), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda p: p[0])] for c, v in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if c is not None else 0
        built[c] = tuple((own.get(c - c % 100, []) if c is not None else [])[:h] + ts[h:])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, p in built.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
        ends[p].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    least = lambda cs: min((c for c in cs if c is not None), default=None)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        es = sorted(ends.get(p, []), key=lambda c: (c is None, c or 0))
        out.append((least(cs), len(p), least(members[p[:-1]]) if p else None, len(cs), kids[p], sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), sha(",".join("null" if c is None else str(c) for c in es))))
    return sorted(out, key=str)


def chat_rows(rng, n):
    rows = []
    for c in rng.sample(range(max(n * 2, 20)), n):
        for t in range(rng.choice([1, 2, 3, 5, 9, 17])):
            rows.append((c, t, rng.choice(["user", "user", None]), rng.choice(["hi", "hi", "hi", "yes é", None, ""])))
    return rows


def check_trie(spark, rows):
    got = [tuple(r) for r in prefix_trie.prefix_trie(turns(spark, rows)).drop("prefix").collect()]
    assert sorted(got, key=str) == brute_trie(rows)


def test_trie_equals_brute_force_in_batches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FIRST", 8)
    monkeypatch.setattr(prefix_trie, "GROWTH", 3)
    check_trie(spark, chat_rows(random.Random(5), 130))


def test_trie_of_awkward_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FIRST", 3)
    rng = random.Random(6)
    copies = [(c, t, "user", f"turn {t}") for c in range(1000, 1040) for t in range(4)]           # one path, many ids
    nested = [(c, t, "a", "x") for c in range(2000, 2012) for t in range(c - 1999)]               # every prefix ends one
    long = [(3000, t, "user", "y" * (t % 7)) for t in range(900)] + [(3107, t, "user", "y" * (t % 7)) for t in range(450)]
    odd = [(None, 1, "user", "no id"), (None, None, "user", "first"), (150, None, None, None), (150, 1, "r", "z"), (150, 0, "r", "z"),
           (0, 0, "user", "hi"), (5, 0, "user", "short")]
    rows = copies + nested + long + odd
    rng.shuffle(rows)
    check_trie(spark, rows)


def test_trie_small_tables(spark):
    assert prefix_trie.prefix_trie(turns(spark, [])).collect() == []
    check_trie(spark, [(450, 0, "user", "taken away by a missing conversation")])
    check_trie(spark, [(400, 0, "user", None)])


def test_two_fattest(spark):
    rows = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(rows, "a int, b int").select("a", "b", prefix_trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)
