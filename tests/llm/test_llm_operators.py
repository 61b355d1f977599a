"""Each text operator against brute force on small tables that hold the awkward rows: nulls, empty and long
texts, ties, repeated rows, extra columns with clashing names, and no rows at all."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pvspark.llm import (bucket_pointer, chat_grammar, components, exact_stream, line_neighbours, order_minhash, pitman_yor,
                         prefix_bpe, suffix_decontam, toxic_segments, url_cascade)
from pvspark.llm.words import words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, did string, size string, row string, key string"
VOCAB = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "did", "size", "row", "key") for i, t in rows], DOCS)


def ascii_low(s):
    return "".join(c.lower() if c.isascii() else c for c in s or "")


def prose(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    """Texts in which every operator finds something."""
    rng = random.Random(3)
    base = prose(rng, 120)
    other = prose(rng, 90)
    edited = base.split()
    edited[60] = "changed"
    passage = prose(rng, 60)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one"), (5, base), (6, base.upper()), (7, " ".join(edited)),
            (8, other + "\n" + passage), (9, passage + "\n" + prose(rng, 40)), (10, "a" * 1500), (11, "é" * 300 + "x"),
            (12, "ab " * 400), (13, prose(rng, 4)), (14, "\\ [INST] </s> ..."), (15, "中文 \U0001f642   x"),
            (16, prose(rng, 6000, 100000)), (None, base), (None, "no id"), (5, base), (21, "idiot trash " + prose(rng, 20)),
            (22, "".join(chr(rng.randrange(32, 0x2fff)) for _ in range(300)))]
    return rows


# ---- 1 near duplicates -----------------------------------------------------------------------------

def brute_classes(rows):
    """least doc_id of the class of each row, by comparing all texts."""
    ids, grams, np_err = order_minhash.WordIds(), {}, np.errstate(over="ignore")
    texts = sorted({t or "" for _, t in rows})
    with np_err:
        for t in texts:
            grams[t] = order_minhash.kmers(*ids.of([t]))[0]
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        x, y = grams[a].tolist(), grams[b].tolist()
        if x and y:
            # longest common subsequence, by the textbook
            line = [0] * (len(y) + 1)
            if len(set(x) & set(y)) / len(set(x) | set(y)) < 0.8:
                continue
            for u in x:
                before = 0
                for j, v in enumerate(y):
                    before, line[j + 1] = line[j + 1], before + 1 if u == v else max(line[j + 1], line[j])
            if line[-1] / (len(x) + len(y) - line[-1]) >= 0.8:
                parent[find(a)] = find(b)
    least = {}
    for i, t in rows:
        c = find(t or "")
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted((str(i), t or "", str(least.get(find(t or "")))) for i, t in rows)


def check_classes(spark, rows):
    got = order_minhash.near_classes(frame(spark, rows)).collect()
    key = {(r.did, r.size): None for r in got}
    assert len(got) == len(rows) and len(key) == len({t or "" for _, t in rows})
    want = collections.Counter((i, c) for i, _, c in brute_classes(rows))
    assert collections.Counter((str(r.doc_id), str(r.class_id)) for r in got) == want


def test_near_classes_brute_force(spark, awkward):
    check_classes(spark, awkward)


def test_near_classes_large_buckets(spark, monkeypatch):
    """A group of near copies far above SMALL, copies of copies, and texts that share only a passage."""
    monkeypatch.setattr(order_minhash, "SMALL", 3)
    monkeypatch.setattr(order_minhash, "STAR", 8)
    rng = random.Random(5)
    base, passage = prose(rng, 150, 5000).split(), prose(rng, 60, 5000)
    rows, n = [], 0
    rows.append((n, " ".join(base)))
    made = [base]
    for _ in range(80):                                     # copies and copies of copies, near and far, longer and shorter
        w = list(rng.choice(made) if rng.random() < 0.3 else base)
        for _ in range(rng.randrange(1, 8)):
            at, how = rng.randrange(len(w)), rng.random()
            if how < 0.6:
                w[at] = f"e{rng.randrange(10**6)}"
            elif how < 0.8:
                del w[at:at + rng.randrange(1, 5)]
            else:
                w.insert(at, f"e{rng.randrange(10**6)}")
        made.append(w)
        rows.append((n := n + 1, " ".join(w)))
    for _ in range(40):
        rows.append((n := n + 1, passage + " " + prose(rng, 40, 10**6)))
    check_classes(spark, rows)


def test_alignment_order_and_band():
    a = np.arange(100, dtype=np.uint64)
    assert order_minhash.aligned(a, a) == 1.0
    assert order_minhash.aligned(a, np.roll(a, 50)) == 0.0                # same set, other order
    assert order_minhash.aligned(a, a[:85]) == 0.85
    b = a.copy()
    b[10], b[11] = b[11], b[10]
    assert order_minhash.aligned(a, b) == 99 / 101


def test_near_dedup_keeps_one(spark, awkward):
    kept = order_minhash.drop_near(frame(spark, [r for r in awkward if r[0] is not None]))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 2 and 6 not in ids and 7 not in ids and 1 not in ids and {0, 8, 9, 16} <= set(ids)


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# ---- 2 exact duplicates ----------------------------------------------------------------------------

def test_exact_dedup(spark, awkward, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_stream, "HOT_LEAST", 1)                       # salt every group
    path = str(tmp_path / "docs")
    frame(spark, awkward).repartition(3).write.parquet(path)
    got = exact_stream.exact_dedup(spark, path).collect()
    groups = collections.defaultdict(list)
    for i, t in awkward:
        groups[ascii_low(t)].append(i)
    want = collections.Counter((str(i), str(max([x for x in g if x is not None], default=None)), len(g),
                                hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    assert collections.Counter((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_stream.drop_copies(spark, frame(spark, awkward))
    assert kept.count() == len(groups) and len(kept.columns) == 9


def test_stream_state_goes_on(spark, tmp_path):
    """Files that come later meet the state of earlier runs."""
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    frame(spark, [(1, "x"), (2, "y")]).write.parquet(path)
    assert {(r.keep.doc_id, r.n) for r in exact_stream.run_state(spark, path, state).collect()} == {(1, 1), (2, 1)}
    frame(spark, [(3, "X")]).write.mode("append").parquet(path)
    assert {(r.keep.doc_id, r.n) for r in exact_stream.run_state(spark, path, state).collect()} == {(3, 2), (2, 1)}


# ---- 3 chats ---------------------------------------------------------------------------------------

def test_chat_round_trip_fuzz():
    rng = random.Random(1)
    bits = [*chat_grammar.CONTROLS, "\\", "\\\\", "[", "]", "x", " ", "\n", "<", "é", "INST"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "", "tool", "[/ROLE]", "a\\"]),
                  "".join(rng.choices(bits, k=rng.randrange(6)))) for _ in range(rng.randrange(1, 5))]
        formatted, got = chat_grammar.round_trip(turns)
        assert [t[:2] for t in chat_grammar.parse(formatted)] == turns
        assert [chat_grammar._unescape(formatted[a:b]) for _, _, a, b in got] == [t for _, t in turns]
    assert chat_grammar.parse("<s>[INST]a[/INST]b") is None and chat_grammar.parse("") is None


def test_chats_null_and_repeated(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, None, None, "x"), (None, 0, "assistant", "\\")]
    chats = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat_grammar.format_chats(chats).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "hi"), ("user", "hi"), ("assistant", "")]
    assert [tuple(t) for t in got[2].turns] == [("", "x")] and got[None].loss == ["\\"]
    assert got[1].formatted == "<s>[INST]hi[/INST][INST]hi[/INST][ANS]</s>"
    assert chat_grammar.format_chats(chats.limit(0)).count() == 0


# ---- 4 BPE -----------------------------------------------------------------------------------------

def test_bpe_equals_library(spark, awkward):
    rng = random.Random(2)
    alphabet = "aaabcdeehinorstuw'’éüßñΣσςİı́ø中字\U0001f642²٣ \t\n\x85\xa0 \x1c​.,!?<|>019"
    texts = [t for _, t in awkward] + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    texts += ["a<|endoftext|>b <|startoftext|>", "<|endoftext|", "hahaha" * 50, "The THE the " * 30]
    lib = Tokenizer.from_file(VOCAB)
    got = prefix_bpe.bpe(frame(spark, list(enumerate(texts))), VOCAB).collect()
    for r in got:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == lib.decode(ids, skip_special_tokens=False)
    assert len(got) == len(texts)


# ---- 5 language model ------------------------------------------------------------------------------

def test_language_model(spark):
    """Base counts by brute force; probabilities sum to one; better than the base on held-out texts."""
    rng = random.Random(4)
    sides = [[f"{i}{p}" for i in range(40)] for p in ("left", "right")]
    rows = [(i, " ".join(rng.choices(sides[i % 2], k=60))) for i in range(200)] + [(200, None), (201, ""), (None, "1left 2Left"), (3, "x y")]
    rows += [(300, "new words only"), (3, "x y")]
    got = pitman_yor.score(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    toks = {k: re.findall("[^\x20\x09-\x0D]+", ascii_low(t)) + ["\n"] for k, (_, t) in enumerate(rows)}
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = collections.Counter(w for k in toks if not held[k] for w in toks[k])
    n, v = sum(c.values()), len(c)
    want = collections.Counter((str(rows[k][0]), held[k], len(t), sum(c[w] > 0 for w in t),
                                round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for k, t in toks.items())
    assert collections.Counter((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    out = [r for r in got if r.held_out and r.n_tokens > 10]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out) + 0.2 * sum(r.n_tokens for r in out)
    assert pitman_yor.score(frame(spark, [(1, "x")]).limit(0)).count() == 0


def test_pitman_yor_with_more_stretches_than_16_bits(spark, monkeypatch):
    """One document a stretch and one range of words: its task sees all of them."""
    monkeypatch.setattr(pitman_yor, "SLICE_ROWS", 1)
    n = (1 << 16) + 300
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('u', id, repeat(' v', cast(id % 4 AS int))) AS text")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        got = pitman_yor.score(docs).select("doc_id", "n_tokens", "held_out", "n_known").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert sorted(r.doc_id for r in got) == list(range(n))
    assert all(r.n_tokens == 2 + r.doc_id % 4 and r.n_known == r.n_tokens - r.held_out for r in got)


def test_pitman_yor_is_a_distribution():
    rng = np.random.default_rng(1)
    n_words, n_ctx = 50, 8
    counts = rng.integers(0, 30, (n_words, n_ctx)) * (rng.random((n_words, n_ctx)) < 0.5)
    counts[0] = 4000                                                        # beyond the exact table
    chunk = pitman_yor.Chunk(np.arange(n_words, dtype=np.uint64), np.full(n_words, n_ctx), np.tile(np.arange(n_ctx), n_words),
                             counts.ravel(), (0.6, 0.4))

    def totals():
        def by(x):
            return np.bincount(chunk.context, x, pitman_yor.CONTEXTS).astype(np.int64)
        return pitman_yor.Totals(by(chunk.count), by(chunk.tables), int(chunk.customers.sum()), int(chunk.parent.sum()),
                                 int(chunk.train.sum()), int((chunk.train > 0).sum()))

    g = totals()
    for k in range(3):
        chunk.sweep(k + 1, g, pitman_yor._numbers(0.6, 0.4))
        g = totals()
        assert (chunk.tables <= chunk.count).all() and ((chunk.tables > 0) == (chunk.count > 0)).all()
        p = chunk.predictive(g).reshape(n_words, n_ctx)
        seen = chunk.train > 0
        unseen = (1 + 0.6 * g.tables[:n_ctx]) / (1 + g.customers[:n_ctx]) * (1 + 0.4 * g.parent_tables) * g.base / (1 + g.parent_customers)
        np.testing.assert_allclose(p[seen].sum(0) + unseen, 1, rtol=1e-9)


def test_seating_follows_its_conditional():
    """Numbers of tables of five customers against the weights written out."""
    d, theta, p, others = 0.4, 1.0, 0.2, 3
    table = pitman_yor.stirling(d)
    stir = {(1, 1): 1.0}
    for c in range(1, 5):
        for t in range(1, c + 2):
            stir[c + 1, t] = stir.get((c, t - 1), 0) + (c - t * d) * stir.get((c, t), 0)
    w = np.array([stir[5, t] * np.prod([(theta + d * (others + i)) * p for i in range(t)]) for t in range(1, 6)])
    n = 40000
    got = pitman_yor.seat(np.full(n, 5), np.full(n, 1), np.full(n, others), np.full(n, p), d, theta, table, np.random.default_rng(0))
    np.testing.assert_allclose(np.bincount(got, minlength=6)[1:] / n, w / w.sum(), atol=0.01)


# ---- 6 decontamination -----------------------------------------------------------------------------

@pytest.mark.parametrize("block_chars", [8_000_000, 40])
def test_decontamination(spark, awkward, monkeypatch, block_chars):
    monkeypatch.setattr(suffix_decontam, "BLOCK_CHARS", block_chars)
    text = dict((i, t) for i, t in awkward if i is not None)
    items = [(1, " ".join(text[5].split()[10:40])), (2, text[9]), (10, "one"), (3, None), (4, "..."), (None, " ".join(text[8].split()[:20])),
             (1, " ".join(text[8].split()[3:18])), (7, " ".join(text[16].split()[-13:]))]
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, row string")
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall(ascii_low(t))
        for p in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[p:p + 13])].add(i)
    want = collections.Counter()
    for i, t in awkward:
        w, hit, found = word.findall(ascii_low(t)), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in windows:
                    hit |= set(range(p, p + k))
                    found |= windows[tuple(w[p:p + k])] - {None}
        want[str(i), len(w), len(hit), tuple(sorted(found)), 0 < len(w) <= 20 * len(hit)] += 1
    rows = suffix_decontam.decontaminate(frame(spark, awkward), bench).collect()
    assert collections.Counter((str(r.row.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in rows) == want
    assert max(m.words for r in rows for m in r.matches if r.row.doc_id == 9) == len(word.findall(text[9]))
    assert suffix_decontam.decontaminate(frame(spark, awkward), bench.limit(0)).filter("n_hit > 0").count() == 0
    assert suffix_decontam.decontaminate(frame(spark, awkward).limit(0), bench).count() == 0


# ---- 7 lines ---------------------------------------------------------------------------------------

def test_lines_brute_force(spark):
    rng = random.Random(6)
    base = prose(rng, 14).split()
    lines = [" ".join(base), " ".join(base).upper(), " ".join(base[:5] + base[6:]), " ".join(base[:3] + ["z"] + base[4:]),
             " ".join(base + ["tail"]), " ".join(["z"] + base), " ".join(base[1:]), "short line", "short  line", "short lime", "", "  "]
    lines += [" ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(7, 11))) for _ in range(60)]
    rows = [(k, "\n".join(rng.choices(lines, k=6))) for k in range(30)] + [(50, None), (51, ""), (None, "\n".join(lines[:4]))]
    rows.append(rows[3])

    def alike(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < line_neighbours.MIN_WORDS or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    places = sorted({(math.inf if i is None else i, n, tuple(l.split())) for i, t in rows
                     for n, l in enumerate(ascii_low(t).split("\n")) if l.strip()})
    gone = collections.defaultdict(set)
    for k, (i, n, w) in enumerate(places):
        if any(alike(w, x[2]) for x in places[:k] if x[:2] != (i, n)):
            gone[i].add(n)
    got = line_neighbours.summary(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.dropped_lines == ",".join(map(str, sorted(gone[math.inf if r.doc_id is None else r.doc_id]))), r
    assert sum(r.n_alike for r in got) > 0 and sum(r.n_equal for r in got) > 0
    cut = {r.doc_id: r.text for r in line_neighbours.drop_lines(frame(spark, rows)).collect()}
    assert cut[50] is None and cut[4] == "\n".join(l for n, l in enumerate(rows[4][1].split("\n")) if n not in gone[4])
    assert line_neighbours.summary(frame(spark, rows).limit(0)).count() == 0


def test_lines_of_many_words(spark):
    """Lines of 1 to 20,000 words, of block borders too, with one word changed, put in or left out at either end and inside."""
    rng = random.Random(16)
    rows = []
    for n in (8, 63, 64, 65, 66, 128, 129, 130, 20_000):
        words = [f"w{rng.randrange(1000)}" for _ in range(n)]
        at = sorted({0, 1, n // 2, n - 2, n - 1})
        lines = [words]
        for i in at:
            lines += [words[:i] + ["new"] + words[i + 1:], words[:i] + words[i + 1:], words[:i] + ["put"] + words[i:]]
        lines += [words + ["put"], words[:1] + ["two", "more"] + words[3:] + ["end"]]
        rows.append((n, "\n".join(" ".join(x) for x in lines)))
    for r in line_neighbours.summary(frame(spark, rows)).collect():
        # the line itself stays, and the one of three edits; of 8 words, those of 7 are too short to be compared
        lines = [l.split() for l in dict(rows)[r.doc_id].split("\n")]
        stay = {0, len(lines) - 1} | {k for k, l in enumerate(lines) if len(l) < line_neighbours.MIN_WORDS and l not in lines[:k]}
        assert r.dropped_lines == ",".join(str(k) for k in range(len(lines)) if k not in stay), r.doc_id


# ---- 8 substrings ----------------------------------------------------------------------------------

@pytest.mark.parametrize("contexts", [4096, 1])
def test_repeated_bytes(spark, awkward, monkeypatch, contexts):
    monkeypatch.setattr(bucket_pointer, "CONTEXTS", contexts)               # both ways of the last step
    monkeypatch.setattr(bucket_pointer, "PIECE", 4096)                      # long texts come in pieces
    got = bucket_pointer.repeated_bytes(frame(spark, awkward)).collect()
    seen = collections.Counter()
    for _, t in awkward:
        b = (t or "").encode()
        seen.update(b[p:p + 200] for p in range(len(b) - 199))
    want = collections.Counter()
    for i, t in awkward:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                hit[p:p + 200] = b"\1" * 200
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        spans = len(re.findall(b"\1+", bytes(hit)))
        want[str(i), len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert collections.Counter((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert bucket_pointer.repeated_bytes(frame(spark, awkward).limit(0)).count() == 0


# ---- 9 URLs ----------------------------------------------------------------------------------------

URLS = ["http://a.example.net/en/1", "https://EXAMPLE.net/de/", "https://x.org/fr/?q#z", "http://example.com/de", "http://example.com/de/x",
        "net/", None, "", "://net/", "ftp://net", "http://net?/en/", "http://notexample.net/en/", "http://a.b.c.net/x#/fr/", "http://org/fr/",
        "http://e.org/en/", "http://x.NET/" + "y" * 5000, "http://x.com.net/", "://", "http://a..net/", "http://www.example.com/de/?"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(URLS + URLS[:2])], "page_id long, url string, host string, path string")
    got = {r.page_id: r for r in url_cascade.judge(pages).collect()}
    assert len(got) == len(URLS) + 2
    for k, u in enumerate(URLS):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h + p), h + p, v) for h, p, v in url_cascade.RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit)[1:] if fit else (None, "allow")
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, rule, verdict), u
    assert url_cascade.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    """Exact over the whole universe, although single filters have false positives."""
    universe = spark.range(20000).selectExpr("concat('k', id) AS key")
    listed = [f"k{i}" for i in range(0, 20000, 40)]
    levels = url_cascade.build_cascade(universe, listed)
    assert len(levels) > 2
    member = universe.filter(url_cascade.member(universe["key"], levels))
    assert {r.key for r in member.collect()} == set(listed)
    assert universe.filter(url_cascade.passes(universe["key"], levels[0])).count() > len(listed)


# ---- 10 toxicity -----------------------------------------------------------------------------------

def brute_segments(scores):
    """All maximal scoring segments by their definition: recursively the best one (shortest, leftmost)."""
    best = max(((sum(scores[a:b]), a - b, -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 1e-12:
        return []
    a, b = best[3:]
    return brute_segments(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in brute_segments(scores[b:])]


def test_maximal_segments():
    rng = random.Random(8)
    for _ in range(300):
        scores = [rng.choice([-3.0, -1.0, -0.5, 1.25, 2.1, 4.3]) + rng.random() / 100 for _ in range(rng.randrange(14))]
        assert [s[:2] for s in toxic_segments.maximal_segments(np.array(scores))] == brute_segments(scores)


def test_toxicity_held_out(spark):
    rng = random.Random(9)
    bad = ["vile", "nasty", "awful", "creep"]
    rows, labels = [], []
    for i in range(300):
        w = prose(rng, rng.randrange(20, 200)).split()
        if i % 5 == 0:
            at = rng.randrange(len(w))
            w[at:at] = rng.choices(bad, k=3)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(900, None), (901, ""), (None, "vile nasty awful"), (5, rows[5][1]), (902, prose(rng, 20000, 10**6))]
    labels += [(None, 1, 1), (7, None, None), (10**9, 0, 1)]
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxic_segments.fit(docs, lab)
    got = toxic_segments.score(docs, model).select("row.doc_id", "score", "passages").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        if r.doc_id is not None and r.doc_id < 300:
            assert (r.score >= 0.3) == (r.doc_id % 5 == 0)
        if r.doc_id in (900, 901, 902):
            assert r.score < 0.3
    p = next(r for r in got if r.doc_id == 0).passages
    w = words(rows[0][1])
    assert p and any(x.decode() in bad for x in w[p[0].start:p[0].stop])
    # one class only, no labels, no documents
    clean = lab.filter("toxic = 0")
    assert {r.score for r in toxic_segments.score(docs, toxic_segments.fit(docs, clean)).collect()} == {0.0}
    assert {r.score for r in toxic_segments.score(docs, toxic_segments.fit(docs, lab.limit(0))).collect()} == {0.0}
    assert toxic_segments.score(docs.limit(0), model).count() == 0


def test_toxicity_of_many_rare_words(spark):
    """40 insults, each in a few per cent of the toxic documents and in no clean one."""
    rng = random.Random(10)
    bad = ["".join(rng.choices("bcdfghjklmnprstvz", k=9)) for _ in range(40)]
    rows = []
    for i in range(1200):
        w = prose(rng, rng.randrange(30, 120)).split()
        if i % 10 == 0:
            at = rng.randrange(len(w))
            w[at:at] = rng.sample(bad, 4)
        rows.append((i, " ".join(w)))
    docs = frame(spark, rows)
    lab = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxic_segments.fit(docs, lab)
    got = {r.doc_id: r.score for r in toxic_segments.score(docs, model).select("row.doc_id", "score").collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % toxic_segments.FOLDS == toxic_segments.HELD_OUT]
    toxic = [i for i in held if i % 10 == 0]
    found = [i for i in held if got[i] >= toxic_segments.CUTOFF]
    assert len(toxic) > 15 and len(set(toxic) & set(found)) >= 0.9 * max(len(toxic), len(found))


@pytest.mark.parametrize("n0, n1", [(260, 40), (2700, 300), (10_000, 1_000), (10_000, 10_000)])
def test_toxic_only_words_count_at_every_size(spark, n0, n1):
    counted = spark.createDataFrame([(-1, n0, n1), (1, 0, 5), (2, n0 // 10, n1 // 10)], "feature long, clean long, toxic long")
    table = toxic_segments._table(counted)
    assert table[1][0] > toxic_segments.DRIFT and 2 not in table
