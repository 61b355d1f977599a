"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of bounded size and builds a word suffix array over a shard: all
word positions sorted by the words that follow, documents being kept apart by a separator. Words that
no benchmark item has share one symbol, and positions that start with it are left out of the array: no
test suffix can match there. Then every test suffix is binary-searched in it: the equal range of its first
13 words (of the whole item, if that is shorter) gives all places of that window; neighbouring hits join
to the longest verbatim matches. The documents never leave their task, so nothing is shuffled and no key
can be hot.

The benchmark goes to the tasks in blocks of at most ``BLOCK_CHARS`` characters, one broadcast each;
a task holds one block at a time, and hits of all blocks are joined before counting. A larger benchmark
makes more blocks, not larger ones.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A document word inside any
occurrence of a window is hit; a document is contaminated if it has hits and at least a twentieth of its
words are hit.

Defined results: null or empty texts have no words and are never contaminated; items without words are
skipped; a null item_id counts for hits but isn't listed among the items; items that share an id are
one; repeated documents are judged one by one; other columns pass through untouched in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pvspark.llm.common import small_batches
from pvspark.llm.words import slices, words

WINDOW = 13
SHARE = 20                     # contaminated: SHARE * n_hit >= n_words
BLOCK_CHARS = 8_000_000        # of benchmark text a broadcast
SHARD_ROWS, SHARD_CHARS = 2_000, 8_000_000
SEPARATOR, OTHER, FIRST = 0, 1, 2


class Block:
    """The windows of some benchmark items, as symbol sequences."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.symbols: dict[bytes, int] = {}
        for _, ws in items:
            for w in ws:
                self.symbols.setdefault(w, len(self.symbols) + FIRST)
        self.bits = max(2, (len(self.symbols) + FIRST).bit_length())
        self.per_key = max(1, min(window, 63 // self.bits))
        self.n_keys = -(-window // self.per_key)
        rows, size, item, at = [], [], [], []
        for n, (_, ws) in enumerate(items):
            k = min(len(ws), window)
            for p in range(len(ws) - k + 1 if k else 0):
                row = [self.symbols[w] for w in ws[p:p + k]]
                rows.append(row + [0] * (self.n_keys * self.per_key - k))
                size.append(k)
                item.append(n)
                at.append(p)
        self.sequences = np.array(rows, np.int64).reshape(len(rows), self.n_keys * self.per_key)
        self.size, self.item, self.at = (np.array(x, np.int64) for x in (size, item, at))
        self.ids = [i for i, _ in items]

    def symbol_array(self, docs: list[list[bytes]]) -> np.ndarray:
        """Symbols of the documents, each followed by a separator."""
        get, out = self.symbols.get, []
        for ws in docs:
            out += [get(w, OTHER) for w in ws]
            out.append(SEPARATOR)
        return np.array(out, np.int64)


class SuffixArray:
    def __init__(self, symbols: np.ndarray, block: Block):
        n, k = block.per_key, block.n_keys
        padded = np.concatenate([symbols, np.zeros(n * k, np.int64)])
        packed = np.zeros(len(symbols) + n * (k - 1), np.int64)      # the n symbols from each position on
        for j in range(n):
            packed = (packed << block.bits) | padded[j:j + len(packed)]
        start = np.flatnonzero(symbols >= FIRST)
        keys = [packed[start + n * j] for j in range(k)]
        order = np.lexsort(keys[::-1])
        self.positions = start[order]
        self.keys = [x[order] for x in keys]

    @staticmethod
    def _bound(values, lo, hi, target, right: bool):
        """Binary search of each target in its own sorted range of ``values``."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            at = values[np.minimum(mid, len(values) - 1)]
            less = open_ & ((at <= target) if right else (at < target))
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)

    def search(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Range of the array that each window of the block matches."""
        n, bits = block.per_key, block.bits
        lo = np.zeros(len(block.size), np.int64)
        hi = np.full(len(block.size), len(self.positions), np.int64)
        if not len(self.positions):
            return lo, lo
        for j, values in enumerate(self.keys):
            part = block.sequences[:, n * j:n * (j + 1)]
            low = np.zeros(len(part), np.int64)
            for c in range(n):
                low = (low << bits) | part[:, c]
            fixed = np.clip(block.size - n * j, 0, n)             # symbols of this key that count
            high = low + (np.int64(1) << (bits * (n - fixed))) - 1
            on = fixed > 0
            a = self._bound(values, lo, hi, low, False)
            b = self._bound(values, lo, hi, high, True)
            lo, hi = np.where(on, a, lo), np.where(on, b, hi)
        return lo, hi


def shard_hits(docs: list[list[bytes]], block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All places of all windows: position in the shard's symbols, window; and where documents start."""
    symbols = block.symbol_array(docs)
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])]).astype(np.int64)
    array = SuffixArray(symbols, block)
    lo, hi = array.search(block)
    n = hi - lo
    window = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return array.positions[at], window, starts, symbols


def longest_matches(place, window, block: Block, starts) -> list[tuple[int, int, int, int, int]]:
    """(document, word, item, item word, words) of each maximal run of hits that move on together."""
    if not len(place):
        return []
    item, at, size = block.item[window], block.at[window], block.size[window]
    order = np.lexsort((place, place - at, item))
    place, item, at, size = place[order], item[order], at[order], size[order]
    new = np.ones(len(place), bool)
    new[1:] = (item[1:] != item[:-1]) | ((place - at)[1:] != (place - at)[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    doc = np.searchsorted(starts, place[first], "right") - 1
    return list(zip(doc.tolist(), (place[first] - starts[doc]).tolist(), item[first].tolist(), at[first].tolist(),
                    (place[last] + size[last] - place[first]).tolist(), strict=True))


def judge_shard(docs: list[list[bytes]], blocks, share: int):
    """Per document: n_words, n_hit, items (sorted), matches."""
    n_words = np.array([len(d) for d in docs], np.int64)
    total = int(n_words.sum()) + len(docs)
    edge = np.zeros(total + 1, np.int64)
    items: list[set[int]] = [set() for _ in docs]
    matches: list[list[tuple[int, int | None, int, int]]] = [[] for _ in docs]
    for block in blocks:
        place, window, starts, _ = shard_hits(docs, block)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + block.size[window], -1)
        for d, pos, item, item_pos, size in longest_matches(place, window, block, starts):
            item_id = block.ids[item]
            matches[d].append((pos, item_id, item_pos, size))
            if item_id is not None:
                items[d].add(item_id)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    ends = np.cumsum(n_words + 1)
    n_hit = hit[ends] - hit[ends - n_words - 1]
    return n_words, n_hit, [sorted(i) for i in items], matches


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> list:
    """Broadcasts of at most BLOCK_CHARS characters (one longer item is a block of its own)."""
    sc = benchmark.sparkSession.sparkContext
    out, held, chars = [], [], 0
    rows = benchmark.select(F.col(id_col).cast("bigint"), F.col(text_col)).toLocalIterator()
    for item, text in rows:
        ws = words(text)
        if not ws:
            continue
        if held and chars + len(text) > BLOCK_CHARS:
            out.append(sc.broadcast(held))
            held, chars = [], 0
        held.append((item, ws))
        chars += len(text)
    return [*out, sc.broadcast(held)] if held else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", keep: list[str] | None = None, window: int = WINDOW,
                  share: int = SHARE) -> DataFrame:
    """``row`` (struct of the ``keep`` columns, default all), n_words, n_hit, items (sorted ids), matches
    (word, item_id, item_word, words: the longest verbatim matches), contaminated."""
    small_batches(docs.sparkSession)
    blocks = _blocks(benchmark, item_id_col, item_text_col, window)
    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)])
    match = T.StructType([T.StructField("word", T.IntegerType()), T.StructField("item_id", T.LongType()),
                          T.StructField("item_word", T.IntegerType()), T.StructField("words", T.IntegerType())])
    given = docs.select(kept.alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([given.schema["row"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.LongType())),
                           T.StructField("matches", T.ArrayType(match))])
    arrow_match = pa.list_(pa.struct([("word", pa.int32()), ("item_id", pa.int64()), ("item_word", pa.int32()),
                                      ("words", pa.int32())]))

    def run(batches):
        only = Block(blocks[0].value, window) if len(blocks) == 1 else None
        for part in slices(batches, SHARD_ROWS, 1, SHARD_CHARS):
            each = [only] if only else (Block(b.value, window) for b in blocks)
            n_words, n_hit, items, matches = judge_shard([words(t) for t in part.column(1).to_pylist()], each, share)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.int64())),
                 pa.array([[{"word": w, "item_id": i, "item_word": iw, "words": n} for w, i, iw, n in m]
                           for m in matches], arrow_match)],
                ["row", "n_words", "n_hit", "items", "matches"])

    return (given.mapInArrow(run, schema)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))
