"""Substring dedup by bucket-pointer refinement.

A byte goes if a ``length``-byte (200) string that covers it also starts anywhere else in the corpus.

Every position has a bucket identifier: first that of its q-gram (q = 50), then the one of twice the depth,
made from its own identifier and the identifier of the position one depth further on, and again, so each
refinement reuses the last one's result, until depth 200. Identifiers are fingerprints of the content, so
that all tasks name the same bucket alike; Spark's shuffles do the sorting into buckets, and at each step
only buckets with several members go on:

1. *q-gram buckets.* Only one position in about 76 enters: the anchor of each window, the smallest (hashed)
   q-gram inside it. Equal windows have equal anchors at equal places, so no repeat is lost. Consecutive
   windows with the same anchor are one row. Anchors whose q-gram bucket has one member are done.
2. *Context buckets.* Rows are refined by the identifiers of their first and last window. All windows of
   a row in a bucket with several members repeat.
3. *Window buckets.* What is left (edges of passages, places near an edit) is refined to depth 200, together
   with one row for each repeated context of the same q-gram bucket. The contexts of a q-gram bucket go to
   one task with their bytes if they are at most ``CONTEXTS``; larger buckets are dealt out as one row a
   window, so that no task gets an unbounded group. Both ways are exact.

Equal texts are one text with a count from the start; with a count above one every window repeats. Texts
are kept in a table bucketed by fingerprint and length, so that later steps join marks to them without
moving texts again. All aggregations combine map-side, and joins are on identifiers whose other side has
one row a key, so a passage that a third of all documents hold is split like any other input.

Fingerprints: texts by 64-bit hash and length, contexts and windows by 128 bits.

Defined results: null counts as empty; texts shorter than ``length`` keep all bytes; matches never cross
documents, but may overlap within one; repeated rows are copies; other columns and null ids don't matter.
Texts of any length are cut into pieces of bounded size (with enough overlap) for the numeric work.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import distinct_texts, drop_bucketed, materialise, small_batches, text_key
from pvspark.llm.words import slices

LENGTH = 200
Q = 50                                 # LENGTH is Q * 4: two doublings
REACH = LENGTH - Q + 1                 # q-grams of a window
PIECE = 1 << 20                        # bytes worked on at once
SLICE_ROWS = 4_000
PLACE_BITS = 24
CONTEXTS = 4_096                       # of a q-gram bucket that one task refines
_U = np.uint64

ANCHORS = "ah long, ch long, did long, size int, start int, n int"
CONTEXT = "ah long, did long, size int, start int, context binary"
WINDOWS = "w1 long, w2 long, did long, size int, start int"
RESULT = "did long, size int, n_removed long, n_spans long, kept_sha256 string"


@cache
def _tables(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random byte values; powers of an odd base and of its inverse (mod 2^64) for 2^bits bytes."""
    values = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=_U)
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[_U(1)], np.full((1 << bits) - 1, base, _U)]), dtype=_U)
        back = np.cumprod(np.concatenate([[_U(1)], np.full((1 << bits) - 1, inverse, _U)]), dtype=_U)
    return values, powers, back


def _mix(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Identifier of a pair of identifiers."""
    x = a * _U(0xBF58476D1CE4E5B9 + 2 * seed) + (b ^ (b >> _U(29))) * _U(0x94D049BB133111EB)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def _qgrams(data: np.ndarray) -> np.ndarray:
    """Identifier of the Q bytes from each position on."""
    n = len(data)
    values, powers, back = _tables(max(16, n.bit_length()))
    sums = np.empty(n + 1, _U)
    sums[0] = 0
    np.cumsum(values[data] * powers[:n], out=sums[1:])
    return (sums[Q:] - sums[:-Q]) * back[:n - Q + 1]


def _refine(ids: np.ndarray, depth: int, seed: int) -> np.ndarray:
    """Identifiers of twice the depth, from those at each position and ``depth`` further on."""
    return _mix(ids[:-depth], ids[depth:], seed)


def _windows(grams: np.ndarray, seed: int) -> np.ndarray:
    return _refine(_refine(grams, Q, seed), 2 * Q, seed)


def _first_least(keys: np.ndarray, reach: int) -> np.ndarray:
    """For each position the least of the ``reach`` keys from there on (block-wise running minima)."""
    n = len(keys)
    padded = np.full(-(-n // reach) * reach, np.iinfo(np.uint64).max, _U)
    padded[:n] = keys
    rows = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - reach + 1], ahead[reach - 1:n])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of the texts that lie end to end in ``data``: q-gram identifier of the anchor, context
    identifier, position of the first window, number of windows."""
    if len(data) < LENGTH:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    grams = _qgrams(data)
    wins = _windows(grams, 1)
    place = np.arange(len(grams), dtype=_U)
    low = _U((1 << PLACE_BITS) - 1)
    at = (_first_least((_mix(grams, grams, 7) & ~low) | place, REACH) & low).astype(np.int64)
    p = np.arange(len(at))
    text = np.searchsorted(ends, p, "right")
    whole = p + LENGTH <= ends[text]
    p, at, text = p[whole], at[whole], text[whole]
    if not len(p):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    new = np.ones(len(p), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    n = last - first + 1
    context = _mix(wins[p[first]], wins[p[last]], 3) ^ n.astype(_U)
    return grams[at[first]].view(np.int64), context.view(np.int64), p[first], n


def pieces(texts: list[bytes]):
    """(index of text, offset in it, bytes): whole texts, or overlapping parts of long ones."""
    for i, t in enumerate(texts):
        for start in range(0, max(1, len(t) - LENGTH + 1), PIECE - LENGTH + 1):
            yield i, start, t[start:start + PIECE]


def batched(texts: list[bytes]):
    """Lists of pieces with at most PIECE bytes together."""
    held, size = [], 0
    for piece in pieces(texts):
        if held and size + len(piece[2]) > PIECE:
            yield held
            held, size = [], 0
        held.append(piece)
        size += len(piece[2])
    if held:
        yield held


def _anchor_batches(batches):
    with np.errstate(over="ignore"):
        for part in slices(batches, SLICE_ROWS, 2, PIECE):
            did, size = (part.column(k).to_numpy() for k in (0, 1))
            for held in batched([(t or "").encode() for t in part.column(2).to_pylist()]):
                ends = np.cumsum([len(x[2]) for x in held])
                ah, ch, at, n = anchors(np.frombuffer(b"".join(x[2] for x in held), np.uint8), ends)
                of = np.searchsorted(ends, at, "right")
                row = np.array([x[0] for x in held])[of]
                offset = np.array([x[1] for x in held])[of] + at - np.concatenate([[0], ends[:-1]])[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ah), pa.array(ch), pa.array(did[row]), pa.array(size[row], pa.int32()),
                     pa.array(offset, pa.int32()), pa.array(n, pa.int32())],
                    ["ah", "ch", "did", "size", "start", "n"])


def _cut(part):
    """Row, first window and bytes of each marked context: columns did, size, text, marks (start, n, ah)."""
    for i, (text, marks) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
        data = text.encode()
        for m in marks:
            yield i, m, data[m["start"]:m["start"] + m["n"] + LENGTH - 1]


def depth_ids(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Depth-200 identifiers (two hashes) of all windows of the contexts; context and place of each."""
    grams = _qgrams(np.frombuffer(b"".join(contexts), np.uint8))
    lens = np.array([len(c) for c in contexts])
    n = lens - LENGTH + 1
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    p = np.repeat(np.cumsum(lens) - lens, n) + inner
    return _windows(grams, 1)[p], _windows(grams, 2)[p], np.repeat(np.arange(len(lens)), n), inner


def _stretches(sizes: list[int], most: int):
    """Ranges of items with at most ``most`` bytes together (a larger item alone)."""
    at = 0
    while at < len(sizes):
        stop, total = at, 0
        while stop < len(sizes) and (stop == at or total + sizes[stop] <= most):
            total += sizes[stop]
            stop += 1
        yield at, stop
        at = stop


def _window_batches(batches):
    """One row a window, for the q-gram buckets with very many contexts."""
    with np.errstate(over="ignore"):
        for part in slices(batches, SLICE_ROWS, 2, PIECE):
            did, size = (part.column(k).to_numpy() for k in (0, 1))
            cut = list(_cut(part))
            for a, b in _stretches([len(c[2]) for c in cut], PIECE):
                w1, w2, of, inner = depth_ids([c[2] for c in cut[a:b]])
                row = np.array([c[0] for c in cut[a:b]])[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(did[row]),
                     pa.array(size[row], pa.int32()),
                     pa.array(np.array([c[1]["start"] for c in cut[a:b]])[of] + inner, pa.int32())],
                    ["w1", "w2", "did", "size", "start"])


def _context_batches(batches):
    """One row a context, with its bytes."""
    for part in slices(batches, SLICE_ROWS, 2, PIECE):
        cut = list(_cut(part))
        if cut:
            take = pa.array([c[0] for c in cut])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[1]["ah"] for c in cut], pa.int64()), part.column(0).take(take), part.column(1).take(take),
                 pa.array([c[1]["start"] for c in cut], pa.int32()), pa.array([c[2] for c in cut], pa.binary())],
                ["ah", "did", "size", "start", "context"])


def _refine_batches(batches):
    """Rows of a partition in order of their q-gram bucket: runs of windows that repeat within the bucket."""
    def runs(rows):
        if len(rows) < 2:
            return
        w1, w2, of, inner = depth_ids([r[4] for r in rows])
        order = np.lexsort((w2, w1))                        # sorting into depth-200 buckets
        a, b = w1[order], w2[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        at = np.flatnonzero(again)
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (of[at][1:] != of[at][:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(at)))
        row, start = of[at[first]], inner[at[first]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[i][1] for i in row], pa.int64()), pa.array([rows[i][2] for i in row], pa.int32()),
             pa.array([rows[i][3] + k for i, k in zip(row.tolist(), start.tolist(), strict=True)], pa.int32()),
             pa.array(n, pa.int32())], ["did", "size", "start", "n"])

    held: list[tuple] = []
    size = 0
    with np.errstate(over="ignore"):
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if held and size > PIECE and row[0] != held[-1][0]:       # between buckets only
                    yield from runs(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        yield from runs(held)


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans covered by runs of windows (first window, number of windows)."""
    out: list[list[int]] = []
    for start, n in sorted(ranges):
        stop = start + n - 1 + LENGTH
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _removal_batches(batches):
    """Columns did, size, text, marks: what is left of each text."""
    for part in slices(batches, SLICE_ROWS, 2, 8 * PIECE):
        out = []
        for did, size, text, marks in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
            data = text.encode()
            spans = merge([(m["start"], m["n"]) for m in marks])
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            out.append((did, size, sum(b - a for a, b in spans), len(spans), kept.hexdigest()))
        cols = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())],
            ["did", "size", "n_removed", "n_spans", "kept_sha256"])


def _marks(rows: DataFrame) -> DataFrame:
    ah = [c for c in ("ah",) if c in rows.columns]
    return rows.groupBy("did", "size").agg(F.collect_list(F.struct("start", "n", *ah)).alias("marks"))


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    texts, name = distinct_texts(docs, id_col, text_col)
    long = texts.filter(F.col("size") >= LENGTH).select("did", "size", "text")

    # 1. q-gram buckets
    rows = long.mapInArrow(_anchor_batches, ANCHORS)
    several = (rows.groupBy("ah").agg(F.count(F.lit(1)).alias("k"), F.min("ch").alias("lo"), F.max("ch").alias("hi"))
               .filter("k > 1").select("ah", (F.col("lo") == F.col("hi")).alias("alike")))
    shared = materialise(rows.join(several, "ah"), "shared-anchors")
    # 2. context buckets
    mixed = shared.filter("not alike")
    contexts = materialise(mixed.groupBy("ah", "ch").agg(F.count(F.lit(1)).alias("k"),
                                                         F.min(F.struct("did", "size", "start")).alias("one")), "contexts")
    many = contexts.groupBy("ah").agg((F.count(F.lit(1)) > CONTEXTS).alias("many"))
    here = F.struct("did", "size", "start")
    mixed = materialise(mixed.join(contexts, ["ah", "ch"]).join(many, "ah")
                        .select("ah", "did", "size", "start", "n", "many", (F.col("k") > 1).alias("repeats"),
                                (here == F.col("one")).alias("one")), "mixed-anchors")
    sure = (shared.filter("alike").select("did", "size", "start", "n")
            .unionByName(mixed.filter("repeats").select("did", "size", "start", "n")))
    # 3. window buckets: together where the contexts of a q-gram bucket are few, else a row a window
    open_ = mixed.filter("one or not repeats")

    def with_text(rows):
        return texts.join(_marks(rows), ["did", "size"]).select("did", "size", "text", "marks")

    edges = (with_text(open_.filter("not many")).mapInArrow(_context_batches, CONTEXT)
             .repartition("ah").sortWithinPartitions("ah").mapInArrow(_refine_batches, "did long, size int, start int, n int"))
    wins = materialise(with_text(open_.filter("many")).mapInArrow(_window_batches, WINDOWS), "windows")
    again = wins.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("w1", "w2")
    edges = edges.unionByName(wins.join(again, ["w1", "w2"]).select("did", "size", "start", F.lit(1).alias("n")))

    marked = texts.filter("copies = 1").join(_marks(sure.unionByName(edges)), ["did", "size"])
    cut = materialise(marked.select("did", "size", "text", "marks").mapInArrow(_removal_batches, RESULT), "kept")
    copied = texts.filter(f"copies > 1 and size >= {LENGTH}").select(
        "did", "size", F.col("size").cast("bigint").alias("n_removed"), F.lit(1).cast("bigint").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"))
    result = materialise(copied.unionByName(cut), "removed")
    drop_bucketed(spark, name)
    zero = F.lit(0).cast("bigint")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("doc_id"), *text_key(text), F.sha2(text, 256).alias("whole"))
            .join(result, ["did", "size"], "left")
            .select("doc_id", F.col("size").cast("bigint").alias("n_bytes"),
                    F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                    F.coalesce("kept_sha256", "whole").alias("kept_sha256")))
