"""Language-model scoring with a hierarchical Pitman-Yor model.

Each token is a customer in the restaurant of its context, the whole word before (the end token before the first
word); a new table there sends a customer to the restaurant of the context's ending (its last three bytes), a new table
there one to the shared parent, the word's unigram restaurant, whose new tables draw from the uniform base 1 / (V + 1).
There are as many restaurants as there are words and endings. Tokens are the runs without ASCII white space, A-Z
lower-cased, then one end token.

Seating is sampled by Gibbs: a sweep removes the customers of a dish (word) from a restaurant and seats them
again given all others, that is, draws their number of tables from its conditional
S_d(c, t) prod_{i<t} (theta + d (T + i)) p(word), S_d being generalised Stirling numbers; beyond the first
``EXACT`` customers, blocks of doubling size are seated with Poisson many new tables. Then the word's
customers in the endings' restaurants and in the parent are seated likewise. Words are sampled in parallel within a sweep, given the
table totals T of the sweep before. After ``BURN_IN`` sweeps, the predictive probabilities of ``SAMPLES``
sweeps are averaged and used for the scores. Discounts come from the counts of counts (n1 / (n1 + 2 n2)).

Spark: texts are tokenised once, into stretches of documents: a table of word identifiers and places in it. A stretch
sends its different (word, context) pairs with their training counts to chunks, which are ranges of word identifiers
(pairs of words above ``HOT`` of all tokens, at most 1 / HOT words, are dealt by word and ending, so that no task has all
contexts of a frequent word). Chunks are merged and written once, bucketed. A sweep reads them with the letters that they got: every
chunk sends the customers and tables of its contexts to ranges of contexts, where they are summed, and gets back the totals
of the restaurants that it needs. Sampler state (numbers of tables) is written after each sweep. At last, every chunk sends
the log-probability of each pair and the count of each word to the stretches that have them, which sum them by document.
The driver sees sums of whole sweeps only: ten numbers, and the customers of hot words, whose parent it seats.

Defined results: a null text counts as empty (one end token); a null doc_id is never held out; rows that
repeat id and text get the same score, and each counts in training; other columns are ignored; without
training rows, probabilities are the base's alone.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import Scratch, bucketed, drop_bucketed, in_fold, small_batches
from pvspark.llm.words import slices

FOLDS, HELD_OUT = 7, 2
CONTEXTS = 1 << 18                   # contexts of all chunks that one range of totals should get
HOT = 1 / 2000
BURN_IN, SAMPLES = 1, 2
EXACT = 128
STRENGTH = 1.0
SLICE_ROWS, SLICE_CHARS = 16_000, 6_000_000
CHUNK_TOKENS = 1_500_000             # tokens of a chunk, about; their pairs are fewer
ADDERS = 16                          # tasks that add up the chunks' sums for the driver
SAMPLE_WORDS = 4_000                 # of a stretch, for finding hot words
_U = np.uint64
END = xxhash.xxh64_intdigest(b"\n")  # no word is white space


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word identifiers in ascending order, the place in them of each token, the number of tokens of each text, and the
    words' endings (last three bytes)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    flat = lists.flatten()
    there = pc.greater(pc.binary_length(flat), 0)            # text that begins or ends with white space gives empty words
    row = row[there.to_numpy(zero_copy_only=False)]
    words = flat.filter(there).dictionary_encode()
    known = [*words.dictionary.cast(pa.binary()).to_pylist(), b"\n"]
    ids = np.array([xxhash.xxh64_intdigest(w) for w in known], _U)
    endings = np.array([int.from_bytes(w[-3:]) for w in known], np.uint32)
    order = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    sizes = np.bincount(row, minlength=len(texts)) + 1
    code = np.full(len(row) + len(texts), rank[-1])
    code[np.arange(len(row)) + row] = rank[words.indices.to_numpy()]
    return ids[order], code, sizes, endings[order]


# ---- packing -------------------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (a.dtype.num, a.nbytes))], np.int64)
    raw = head.tobytes() + b"".join(a.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    out, at = [], 8 * (2 * n + 1)
    for code, size in head.reshape(n, 2).tolist():
        dtype = _TYPES[code]
        out.append(np.frombuffer(raw, dtype, size // dtype.itemsize, at))
        at += size
    return out


_TYPES = {np.dtype(t).num: np.dtype(t) for t in (np.uint8, np.uint16, np.uint32, np.uint64, np.int32, np.int64, np.float32, np.float64)}


def _small(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _gaps(ids: np.ndarray) -> np.ndarray:
    """Ascending identifiers as planes of their differences' bytes, which compress better."""
    return np.diff(ids, prepend=_U(0)).view(np.uint8).reshape(-1, 8).T.ravel()


def _ids(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(gaps.reshape(8, -1).T).view(_U).ravel(), dtype=_U)


def _contexts(gaps: np.ndarray, endings: np.ndarray) -> np.ndarray:
    """Identifiers of contexts: 48 bits of the word's, and its last two bytes."""
    return _ids(gaps) << _U(16) | endings.astype(_U) & _U(0xFFFF)


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _of(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


# ---- Gibbs sampling ------------------------------------------------------------------------------

def stirling(d: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S_d(c, t) for 1 <= t <= c <= EXACT."""
    out = np.full((EXACT + 1, EXACT + 2), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(EXACT + 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(1, EXACT):
            stay = np.where(t <= c, np.log(np.maximum(c - t * d, 1e-300)) + out[c], -np.inf)
            out[c + 1, 1:] = np.logaddexp(stay[1:], out[c, :-1])
    return out


def seat(c, tables, others, p, d: float, theta: float, table: np.ndarray, rng) -> np.ndarray:
    """New numbers of tables for dishes with ``c`` customers and base probability ``p`` in restaurants that have
    ``others`` further tables; ``tables`` gives the present numbers (kept for c <= 1)."""
    out = np.minimum(tables, c)
    low = 1
    while low < EXACT:                                     # widths 2, 4, 8, ...: few wide rows
        high = low * 2
        rows = np.flatnonzero((np.minimum(c, EXACT) > low) & (np.minimum(c, EXACT) <= high))
        for part in np.array_split(rows, max(1, len(rows) * high // 4_000_000)):
            if not len(part):
                continue
            i = np.arange(high)
            grow = np.log((theta + d * (others[part, None] + i)) * p[part, None])
            logit = np.cumsum(grow, axis=1) + table[np.minimum(c[part], EXACT)][:, 1:high + 1]
            weight = np.exp(logit - logit.max(axis=1, keepdims=True))
            total = np.cumsum(weight, axis=1)
            draw = rng.random(len(part)) * total[:, -1]
            out[part] = np.minimum((total < draw[:, None]).sum(axis=1) + 1, np.minimum(c[part], EXACT))
        low = high
    rows = np.flatnonzero(c > EXACT)
    at = np.full(len(rows), EXACT, np.int64)
    while len(rows):
        size = np.minimum(at, c[rows] - at)
        new = (theta + d * (others[rows] + out[rows])) * p[rows]
        rate = new / (new + at + size / 2 - d * out[rows])
        out[rows] += np.minimum(rng.poisson(size * rate), size)
        at += size
        more = at < c[rows]
        rows, at = rows[more], at[more]
    return out


class Totals:
    """Global numbers: customers and tables of the restaurants of a chunk's contexts, the parent's, the corpus's, the
    customers and tables of hot words in the parent and their tokens, and the restaurants of a chunk's endings."""

    def __init__(self, customers, tables, parent_customers: int, parent_tables: int, tokens: int, types: int, hot=None, middle=None):
        self.customers, self.tables = customers, tables
        self.parent_customers, self.parent_tables = parent_customers, parent_tables
        self.tokens, self.types = tokens, types
        self.hot_customers, self.hot_parent, self.hot_train = hot if hot is not None else [np.zeros(1, np.int64)] * 3
        self.middle_customers, self.middle_tables = middle or (None, None)

    def of(self, customers, tables, middle) -> Totals:
        """With the restaurants of a chunk."""
        return Totals(customers, tables, self.parent_customers, self.parent_tables, self.tokens, self.types,
                      (self.hot_customers, self.hot_parent, self.hot_train), middle)

    @property
    def base(self) -> float:
        return 1 / (self.types + 1)


class Chunk:
    """Pairs of words and contexts and their seating. ``context`` are places in a list of contexts; ``hot`` is the place of
    each word among the hot words, whose other pairs lie in other chunks, or -1; ``ending`` is the place of each context's
    ending (without them, contexts have the unigram restaurants for parents)."""

    def __init__(self, ids, pairs_of_word, context, count, discounts, hot=None, ending=None):
        self.ids, self.context, self.count = ids, context.astype(np.int64), count.astype(np.int64)
        self.word = np.repeat(np.arange(len(ids)), pairs_of_word)
        self.begin = np.cumsum(pairs_of_word, dtype=np.int64) - pairs_of_word
        self.hot = np.full(len(ids), -1) if hot is None else hot
        self.cold = self.hot < 0
        self.train = self._by_word(self.count)
        self.middle = ending is not None
        if self.middle:
            n = int(ending.max()) + 1
            keys, self.up = np.unique(self.word * n + ending[self.context], return_inverse=True)
            self.middle_word, self.ending = np.divmod(keys, n)
            self.middle_begin = _starts(self.middle_word)
        self.d, self.d_middle, self.d1 = discounts[0], discounts[1], discounts[-1]
        self._begin(np.minimum(self.count, 1))             # to begin with, a table for each pair
        self.seed = int(ids[0]) if len(ids) else 0

    def _begin(self, tables):
        self.tables = tables
        if self.middle:
            self.middle_customers = self._by_pair(tables)
            self.middle_tables = np.minimum(self.middle_customers, 1)
        self.customers = self._in_parent()
        self.parent = np.minimum(self.customers, 1)

    def _by_word(self, x):
        return np.add.reduceat(x, self.begin) if len(self.begin) else np.zeros(0, np.int64)

    def _by_pair(self, x):
        """Sums of a number of each pair over the contexts of the same word and ending."""
        return np.bincount(self.up, x, len(self.ending)).astype(np.int64)

    def _in_parent(self):
        return np.add.reduceat(self.middle_tables, self.middle_begin) if self.middle else self._by_word(self.tables)

    def _whole(self, own, of_hot):
        """A number of each word, taken from ``of_hot`` for hot words."""
        return np.where(self.cold, own, of_hot[self.hot])

    def unigram(self, g: Totals) -> np.ndarray:
        customers, parent = self._whole(self.customers, g.hot_customers), self._whole(self.parent, g.hot_parent)
        return ((customers - self.d1 * parent + (STRENGTH + self.d1 * g.parent_tables) * g.base)
                / (STRENGTH + g.parent_customers))

    def above(self, g: Totals, unigram: np.ndarray) -> np.ndarray:
        """Probability that the restaurant above a pair's context gives the word."""
        if not self.middle:
            return unigram[self.word]
        back = (STRENGTH + self.d_middle * g.middle_tables[self.ending]) * unigram[self.middle_word]
        return ((self.middle_customers - self.d_middle * self.middle_tables + back) / (STRENGTH + g.middle_customers[self.ending]))[self.up]

    def sweep(self, number: int, g: Totals, numbers) -> None:
        rng = np.random.default_rng([self.seed, number])
        unigram = self.unigram(g)
        others = np.maximum(g.tables[self.context] - self.tables, 0)
        self.tables = seat(self.count, self.tables, others, self.above(g, unigram), self.d, STRENGTH, numbers[0], rng)
        if self.middle:
            self.middle_customers = self._by_pair(self.tables)
            others = np.maximum(g.middle_tables[self.ending] - self.middle_tables, 0)
            self.middle_tables = seat(self.middle_customers, np.maximum(self.middle_tables, np.minimum(self.middle_customers, 1)), others,
                                      unigram[self.middle_word], self.d_middle, STRENGTH, numbers[1], rng)
        self.customers = self._in_parent()
        rest = np.maximum(g.parent_tables - self.parent, 0)
        self.parent = seat(self.customers, np.maximum(self.parent, np.minimum(self.customers, 1)), rest,
                           np.full(len(rest), g.base), self.d1, STRENGTH, numbers[-1], rng)

    def predictive(self, g: Totals) -> np.ndarray:
        back = (STRENGTH + self.d * g.tables[self.context]) * self.above(g, self.unigram(g))
        return (self.count - self.d * self.tables + back) / (STRENGTH + g.customers[self.context])

    def state(self) -> bytes:
        """Numbers of tables; a dish of at most one customer has as many tables."""
        return pack(_small(self.tables[self.count > 1]), _small(self.middle_tables[self.middle_customers > 1]), _small(self.parent))

    def restore(self, blob: bytes) -> None:
        tables, middle, parent = unpack(blob)
        at = np.minimum(self.count, 1)
        at[self.count > 1] = tables
        self._begin(at)
        self.middle_tables[self.middle_customers > 1] = middle
        self.customers, self.parent = self._in_parent(), parent.astype(np.int64)


_CACHE: dict[tuple[float, ...], tuple[np.ndarray, ...]] = {}


def _numbers(*discounts: float):
    if discounts not in _CACHE:
        _CACHE.clear()
        _CACHE[discounts] = tuple(stirling(d) for d in discounts)
    return _CACHE[discounts]


# ---- Spark steps ---------------------------------------------------------------------------------

def _rows(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _groups(batches, key: int):
    """Rows of the same ``key`` (a column's number), as tuples; the rows come sorted by it."""
    held, name = [], None
    for batch in batches:
        for r in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
            if held and r[key] != name:
                yield name, held
                held = []
            name = r[key]
            held.append(r)
    if held:
        yield name, held


def _find(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Place of each value in ``sorted_``, or -1."""
    if not len(sorted_):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


def _range(ids: np.ndarray, ranges: int) -> np.ndarray:
    return ((ids >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def _stretches(given: DataFrame) -> DataFrame:
    """block (a name), docs (doc_id, whether it is null, whether it trains), tokens (see ``tokens``). The table is written
    once, so its names may be drawn."""
    schema = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("tokens", pa.binary())])

    def run(batches):
        for part in slices(batches, SLICE_ROWS, 2, SLICE_CHARS):
            ids, code, sizes, endings = tokens(part.column(2))
            doc_id, train = part.column(0), part.column(1).to_numpy(zero_copy_only=False)
            docs = pack(doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), train.astype(np.uint8))
            yield _rows(schema, [[uuid.uuid4().int >> 65], [docs], [pack(_gaps(ids), _small(code), _small(sizes), endings)]])

    return given.mapInArrow(run, "block long, docs binary, tokens binary")


def _hot_words(stretches: DataFrame, scratch: Scratch) -> tuple[np.ndarray, int]:
    """Words that may hold more than HOT of all tokens (only the work is dealt out by this), and the number of tokens."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])

    def run(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                ids, code, *_ = unpack(blob)
                ids = _ids(ids)
                n = np.bincount(code, minlength=len(ids))
                top = np.argsort(-n)[:SAMPLE_WORDS]
                yield _rows(schema, [np.append(ids[top].view(np.int64), 0), np.append(n[top], 0), np.append(np.zeros(len(top), np.int64), n.sum())])

    counts = scratch.write(stretches.select("tokens").mapInArrow(run, "id long, n long, total long")
                           .groupBy("id").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "word-heads")
    total = counts.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("t")).collect()[0].t
    rows = counts.filter(F.col("n") > total * HOT).select("id").collect()     # at most 1 / HOT
    return np.sort(np.array([r.id for r in rows], np.int64).view(_U)), total


class Pairs:
    """The different (word, context) pairs of a stretch, in order of their chunks."""

    def __init__(self, ids, code, endings, hot, ranges: int):
        n = len(ids)
        context = np.empty(len(code), np.int64)
        context[0], context[1:] = np.searchsorted(ids, _U(END)), code[:-1]
        keys, of = np.unique(code.astype(np.int64) * n + context, return_inverse=True)
        word, context = np.divmod(keys, n)
        chunk = _range(ids, ranges)[word]
        frequent = (_find(ids, hot) >= 0)[word]
        chunk[frequent] = _range(_mix(ids[word[frequent]], endings[context[frequent]].astype(_U)), ranges)
        order = np.argsort(chunk, kind="stable")
        self.word, self.context, self.chunk = word[order], context[order], chunk[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.of = place[of]                                   # of each token
        self.first = _starts(self.chunk, self.word)           # first pair of each word in a chunk
        self.cuts = np.append(_starts(self.chunk), len(order))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * _U(0xBF58476D1CE4E5B9) + b * _U(0x94D049BB133111EB)
        x = (x ^ (x >> _U(31))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _chunks(stretches: DataFrame, hot, ranges: int) -> DataFrame:
    """chunk, stats (words, pairs of each, contexts, their endings, place in them and training count of each pair), contexts (how many),
    members (for each stretch, which pairs it has)."""
    sent = pa.schema([("chunk", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())])
    made = pa.schema([("chunk", pa.int32()), ("stats", pa.binary()), ("contexts", pa.int64()), ("members", pa.binary())])

    def deal(batches):
        for batch in batches:
            for block, docs, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                ids, code, sizes, endings = unpack(blob)
                ids = _ids(ids)
                pairs = Pairs(ids, code, endings, hot.value, ranges)
                train = np.bincount(pairs.of, np.repeat(unpack(docs)[2], sizes), len(pairs.word)).astype(np.int64)
                blobs = []
                words = np.searchsorted(pairs.first, pairs.cuts)
                for k in range(len(pairs.cuts) - 1):
                    a, b = pairs.cuts[k], pairs.cuts[k + 1]
                    first = pairs.first[words[k]:words[k + 1]]
                    contexts, at = np.unique(pairs.context[a:b], return_inverse=True)
                    blobs.append(pack(_gaps(ids[pairs.word[first]]), _small(_of(first - a, b - a)), _gaps(ids[contexts] >> _U(16)), endings[contexts], _small(at), _small(train[a:b])))
                yield _rows(sent, [pairs.chunk[pairs.cuts[:-1]], [block] * len(blobs), blobs])

    def merge(batches):
        for chunk, rows in _groups(batches, 0):
            parts = [unpack(r[2]) for r in rows]
            words, word = np.unique(np.concatenate([_ids(p[0]) for p in parts]), return_inverse=True)
            contexts, one, context = np.unique(np.concatenate([_contexts(p[2], p[3]) for p in parts]), return_index=True, return_inverse=True)
            endings = np.concatenate([p[3] for p in parts])[one]
            word = np.repeat(word, np.concatenate([p[1] for p in parts]))
            base = np.cumsum([0] + [len(p[3]) for p in parts])
            context = context[np.concatenate([p[4].astype(np.int64) + k for p, k in zip(parts, base.tolist(), strict=False)])]
            train = np.concatenate([p[5] for p in parts]).astype(np.int64)
            sizes = np.array([len(p[5]) for p in parts])
            del parts
            keys = word * len(contexts) + context
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            new = _starts(keys)
            pair = np.empty(len(keys), np.int64)
            pair[order] = np.repeat(np.arange(len(new)), _of(new, len(keys)))
            begin = np.cumsum(sizes) - sizes
            step = np.diff(pair, prepend=0)
            step[begin] = pair[begin]                         # pairs of a stretch ascend
            word, context = np.divmod(keys[new], len(contexts))
            stats = pack(_gaps(words), _small(np.bincount(word, minlength=len(words))), _gaps(contexts >> _U(16)), endings, _small(context),
                         _small(np.add.reduceat(train[order], new)))
            yield _rows(made, [[chunk], [stats], [len(contexts)], [pack(np.array([r[1] for r in rows], np.int64), _small(sizes), _small(step))]])

    return (stretches.mapInArrow(deal, "chunk int, block long, blob binary").repartition(ranges, "chunk")
            .sortWithinPartitions("chunk", "block").mapInArrow(merge, "chunk int, stats binary, contexts long, members binary"))


class Mail:
    """A chunk and its letters: by round, its own state and the totals of its restaurants. ``ids`` names these: contexts,
    tables of endings, customers of endings."""

    def __init__(self, number: int, stats: bytes, letters, hot, discounts):
        ids, pairs, contexts, endings, context, count = unpack(stats)
        ids, contexts = _ids(ids), _contexts(contexts, endings)
        endings, ending = np.unique(endings, return_inverse=True)
        self.chunk = Chunk(ids, pairs, context, count, discounts, _find(ids, hot), ending)
        self.chunk.seed = number + 1
        named = np.concatenate([contexts, *(_mix(endings.astype(_U), _U(k)) for k in (1, 2))])
        self.order = np.argsort(named)
        self.ids, self.cuts = named[self.order], [len(contexts), len(contexts) + len(endings)]
        self.states, parts = {}, {}
        for x in sorted(letters or [], key=lambda x: (x["round"], x["range"])):
            if x["range"] < 0:
                self.states[x["round"]] = x["blob"]
            else:
                parts.setdefault(x["round"], []).append(unpack(x["blob"]))
        self.totals = {k: [self._apart(np.concatenate(v)) for v in zip(*p, strict=True)] for k, p in parts.items()}

    def _apart(self, x):
        out = np.empty(len(x), np.int64)
        out[self.order] = x
        return np.split(out, self.cuts)

    def sums(self, first: bool) -> list[np.ndarray]:
        """Numbers of this chunk by ``ids``; the contexts' customers, which don't change, are told the first time."""
        c, n, m = self.chunk, self.cuts[0], self.cuts[1] - self.cuts[0]
        parts = [np.bincount(c.context, c.tables, n), np.bincount(c.ending, c.middle_tables, m), np.bincount(c.ending, c.middle_customers, m)]
        out = [np.concatenate(parts).astype(np.int64)[self.order]]
        if first:
            out.append(np.concatenate([np.bincount(c.context, c.count, n), np.zeros(2 * m)]).astype(np.int64)[self.order])
        return out

    def at(self, k: int, g: Totals) -> Totals:
        """State and totals after sweep ``k``."""
        self.chunk.restore(self.states[k])
        tables, middle_tables, middle_customers = self.totals[k][0]
        return g.of(self.totals[0][1][0], tables, (middle_customers, middle_tables))


LETTER = "chunk int, round int, range int, blob binary"
_MAILED = pa.schema([("chunk", pa.int32()), ("round", pa.int32()), ("range", pa.int32()), ("blob", pa.binary()), ("sums", pa.list_(pa.int64()))])


def _posted(chunks: DataFrame, letters: DataFrame | None, columns: list[str]) -> DataFrame:
    if letters is None:
        return chunks.select(*columns, F.lit(None).cast("array<struct<round:int,range:int,blob:binary>>").alias("letters"))
    mail = letters.groupBy("chunk").agg(F.collect_list(F.struct("round", "range", "blob")).alias("letters"))
    return chunks.join(mail, "chunk").select(*columns, "letters")


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, frames) if frames else None


def _sweep(chunks: DataFrame, letters: DataFrame | None, hot, totals: list[Totals], discounts, ranges: int) -> DataFrame:
    """Letters of round k = len(totals): states after sweep k (k = 0: at the beginning), sums for the driver, and what each
    range of restaurants gets: see ``Mail.sums``."""
    k = len(totals)

    def run(batches):
        for batch in batches:
            for number, stats, mail in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                box = Mail(number, stats, mail, hot.value, discounts)
                chunk = box.chunk
                if k:
                    chunk.sweep(k, box.at(k - 1, totals[-1]), _numbers(*discounts))
                values = box.sums(not k)
                of = _range(box.ids, ranges)
                cuts = np.append(_starts(of), len(of))
                blobs = [pack(_gaps(box.ids[a:b]), *[_small(v[a:b]) for v in values]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                hots = [np.bincount(chunk.hot[~chunk.cold], x[~chunk.cold], len(hot.value)).astype(np.int64) for x in (chunk.customers, chunk.train)]
                sums = np.concatenate([_more(chunk), *hots])
                yield _rows(_MAILED, [[number] * (len(blobs) + 1), [k] * (len(blobs) + 1), [-1, *of[cuts[:-1]].tolist()], [chunk.state(), *blobs],
                                      [sums] + [None] * len(blobs)])

    return _posted(chunks, letters, ["chunk", "stats"]).mapInArrow(run, LETTER + ", sums array<long>")


def _answers(sent: DataFrame, ranges: int) -> DataFrame:
    """The chunks' letters after a sweep: their states, and the totals of their contexts."""
    schema = pa.schema(list(_MAILED)[:4])

    def run(batches):
        for part, rows in _groups(batches, 2):
            blobs = [unpack(r[3]) for r in rows]
            ids = [_ids(b[0]) for b in blobs]
            _, of = np.unique(np.concatenate(ids), return_inverse=True)
            values = [np.bincount(of, np.concatenate(v)).astype(np.int64)[of] for v in list(zip(*blobs, strict=True))[1:]]
            cuts = np.cumsum([0] + [len(x) for x in ids]).tolist()
            out = [pack(*[_small(v[a:b]) for v in values]) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield _rows(schema, [[r[0] for r in rows], [r[1] for r in rows], [part] * len(rows), out])

    letters = sent.drop("sums")
    return letters.filter("range < 0").unionByName(letters.filter("range >= 0").repartition(ranges, "range")
                                                  .sortWithinPartitions("range").mapInArrow(run, LETTER))


def _totals(sent: DataFrame, hot: np.ndarray, before: Totals | None, number: int, discounts) -> tuple[Totals, list[int]]:
    """Global totals after a sweep, hot words being seated in the parent; and counts of counts n1, n2 of pairs, words with endings, and words."""
    schema, size = pa.schema([("sums", pa.list_(pa.int64()))]), 10 + 2 * len(hot)

    def run(batches):
        x = np.zeros(size, np.int64)
        for batch in batches:
            x += batch.column(0).flatten().to_numpy().reshape(-1, size).sum(0)
        yield _rows(schema, [[x]])

    sums = sent.filter("sums is not null").select("sums").coalesce(ADDERS).mapInArrow(run, "sums array<long>")
    x = sum((np.array(r.sums, np.int64) for r in sums.collect()), np.zeros(size, np.int64))       # at most ADDERS rows
    more, customers, train = x[:10], x[10:10 + len(hot)], x[10 + len(hot):]
    least = np.minimum(customers, 1)
    parent = least
    if before is not None:
        parent = seat(customers, np.maximum(before.hot_parent[:len(hot)], least), np.maximum(before.parent_tables - before.hot_parent[:len(hot)], 0),
                      np.full(len(hot), before.base), discounts[-1], STRENGTH, _numbers(*discounts)[-1], np.random.default_rng([0, number]))
    more = more + np.array([customers.sum(), parent.sum(), 0, (train > 0).sum(), 0, 0, 0, 0, (customers == 1).sum(), (customers == 2).sum()])
    # one place more, which words that aren't hot point to
    return Totals(None, None, *more[:4].tolist(), [np.append(v, 0) for v in (customers, parent, train)]), more[4:].tolist()


def _more(chunk: Chunk) -> np.ndarray:
    """Customers and tables in the parent, tokens, words; dishes with one and two customers at each level. Hot words are left to
    the driver, but for their tokens, pairs and endings."""
    customers = chunk.customers[chunk.cold]
    return np.array([customers.sum(), chunk.parent[chunk.cold].sum(), chunk.train.sum(), (chunk.train[chunk.cold] > 0).sum(),
                     (chunk.count == 1).sum(), (chunk.count == 2).sum(), (chunk.middle_customers == 1).sum(),
                     (chunk.middle_customers == 2).sum(), (customers == 1).sum(), (customers == 2).sum()], np.int64)


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def _probabilities(chunks: DataFrame, letters: DataFrame, hot, totals: list[Totals], discounts) -> DataFrame:
    """block, chunk, blob: the log-probability of each pair that a stretch has in a chunk, and the training tokens of its words."""
    schema = pa.schema([("block", pa.int64()), ("chunk", pa.int32()), ("blob", pa.binary())])
    kept = range(BURN_IN + 1, BURN_IN + SAMPLES + 1)

    def run(batches):
        for batch in batches:
            for number, stats, members, mail in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                box = Mail(number, stats, mail, hot.value, discounts)
                chunk, mean = box.chunk, 0
                for k in kept:
                    g = box.at(k, totals[k])
                    mean = mean + chunk.predictive(g) / len(kept)
                logs, train = np.log10(mean).astype(np.float32), chunk._whole(chunk.train, totals[-1].hot_train)
                blocks, sizes, step = unpack(members)
                ends = np.cumsum(sizes, dtype=np.int64).tolist()
                blobs, a = [], 0
                for b in ends:
                    pair = np.cumsum(step[a:b], dtype=np.int64)
                    word = chunk.word[pair]
                    blobs.append(pack(logs[pair], _small(train[word[_starts(word)]])))
                    a = b
                yield _rows(schema, [blocks, [number] * len(blobs), blobs])

    return _posted(chunks, letters, ["chunk", "stats", "members"]).mapInArrow(run, "block long, chunk int, blob binary")


def _documents(stretches: DataFrame, answers: DataFrame, hot, ranges: int, last: Totals) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])
    floor = math.log10(1 / (last.tokens + last.types + 1))

    def run(batches):
        for batch in batches:
            for docs, blob, answers in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                ids, code, sizes, endings = unpack(blob)
                ids = _ids(ids)
                pairs = Pairs(ids, code, endings, hot.value, ranges)
                parts = [unpack(x["blob"]) for x in sorted(answers, key=lambda x: x["chunk"])]
                logs = np.concatenate([p[0] for p in parts]).astype(float)[pairs.of]
                train = np.zeros(len(ids), np.int64)
                train[pairs.word[pairs.first]] = np.concatenate([p[1] for p in parts])
                row, n = np.repeat(np.arange(len(sizes)), sizes), len(sizes)
                doc_id, null, trains = unpack(docs)
                yield _rows(schema, [pa.array(doc_id, mask=null.astype(bool)), trains == 0, sizes, np.bincount(row, (train > 0)[code], n).astype(np.int64),
                                     np.bincount(row, (np.log10(train + 1) + floor)[code], n), np.bincount(row, logs, n)])

    each = answers.groupBy("block").agg(F.collect_list(F.struct("chunk", "blob")).alias("answers"))
    return (stretches.join(each, "block").select("docs", "tokens", "answers")
            .mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity: one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = in_fold(F.col(id_col), FOLDS, HELD_OUT)
    stretches, first_name = bucketed(_stretches(docs.select(F.col(id_col).cast("bigint").alias("id"), (~held).alias("train"),
                                                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))), ["block"], "stretches")
    found, total = _hot_words(stretches, scratch)
    hot = spark.sparkContext.broadcast(found)
    ranges = max(parts, math.ceil(total / CHUNK_TOKENS))
    chunks, second_name = bucketed(_chunks(stretches, hot, ranges), ["chunk"], "pair_chunks")
    wide = max(1, math.ceil((chunks.agg(F.sum("contexts")).first()[0] or 0) / CONTEXTS))
    discounts, totals, letters = (0.5, 0.5, 0.5), [], []
    for k in range(BURN_IN + SAMPLES + 1):
        mail = [x.filter("range >= 0") if i < k - 1 else x for i, x in enumerate(letters) if i in (0, k - 1)]
        post = Scratch(spark)
        sent = post.write(_sweep(chunks, _union(mail), hot, list(totals), discounts, wide), "letters-sent")
        g, ones = _totals(sent, hot.value, totals[-1] if totals else None, k, discounts)
        totals.append(g)
        if not k:
            discounts = tuple(_discount(a, b) for a, b in zip(ones[::2], ones[1::2], strict=True))
        letters.append(scratch.write(_answers(sent, wide), "letters"))
        post.clear()
    needed = [letters[0].filter("range >= 0"), *letters[BURN_IN + 1:]]
    answers = _probabilities(chunks, _union(needed), hot, totals, discounts)
    result = scratch.keep(_documents(stretches, answers, hot, ranges, totals[-1]), "document-scores")
    for name in (first_name, second_name):
        drop_bucketed(spark, name)
    scratch.clear()
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals[-1].tokens).cast("bigint").alias("train_tokens"),
                         "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
