"""BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a word the last token of its encoding is unique. Going through the word once, an
automaton over the vocabulary reports all tokens that are suffixes of the current prefix; the one that is
*compatible* with the stored last token of the shorter prefix before it is stored with a pointer back. The
pointers give the ids of the whole word. Two tokens are compatible if encoding their concatenation yields
just these two: the merges that made them are undone, latest first, and at each step the pair that meets
at the border must have no merge that would have come earlier. No merge loop runs.

The vocabulary file (a parameter; tokenizers' JSON with end-of-word BPE) fixes normaliser and
pre-tokeniser: NFC, white space, lower case; then contractions, letter runs, single digits, other runs, each
a word over byte characters. All of these stop at white space, so a text is cut there first, and pieces seen
before are looked up in a bounded table. Special tokens in a text become their ids, as in the library.

Defined results: a null text counts as empty, an empty one has no ids and decodes to the empty text; rows
are encoded one by one, so ids, nulls, repeats and other columns don't matter; no rows give no rows. Memory
a task: one batch of texts and the bounded tables.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pvspark.llm.common import small_batches

#: Fixed values of the vocabulary's pre-tokeniser: its pattern, and Unicode white space.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")

END = ""                 # stands for the end-of-word suffix, so that every symbol is made of single characters
KEEP_PIECES = 300_000          # entries of a worker's table of known pieces
KEEP_WORDS = 500_000           # and of the words in them, without case and punctuation
KEEP_PIECE_CHARS = 64
KEEP_PAIRS = 1_000_000
PLAIN = "\u024f"               # up to this character all Unicode versions agree on case and category
ROWS_OUT = 256                 # rows of an output batch
NEVER = 1 << 60

SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"


def _byte_chars() -> list[str]:
    """The printable character of each byte: itself where it is printable, else the next from U+0100."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in kept else chr(spare))
        spare += b not in kept
    return out


class PrefixBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        own = {t: i for t, i in vocab.items() if t not in self.special}
        self.rank: dict[tuple[int, int], int] = {}          # pair -> when it merges
        self.made: dict[int, tuple[int, int, int]] = {}     # token -> (rank, left, right)
        for r, (a, b) in enumerate(model["merges"]):
            a, b = own[a], own[b]
            t = own[self.tokens[a].removesuffix(suffix) + self.tokens[b]]
            self.rank.setdefault((a, b), r)
            self.made.setdefault(t, (r, a, b))
        self.byte_chars = _byte_chars()
        self.library = Tokenizer.from_file(path)             # for normalising rare characters only
        self.pieces: dict[str, bytes] = {}
        self.known_words: dict[str, list[int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._valid: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in own.items():
            if not self.valid(i):                             # such a token is in no encoding
                continue
            text = t.removesuffix(suffix) + END if t.endswith(suffix) and t != suffix else t
            self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    # -- compatibility ---------------------------------------------------------------------------

    def _border_holds(self, left: int, right: int, until: int) -> bool:
        """No merge crosses the border of two tokens before the time ``until``."""
        rank, made = self.rank, self.made
        left_until = right_until = until
        while True:
            r = rank.get((left, right))
            # of equal merges the one further left comes first, so a tie with the right token's own crosses
            if r is not None and r < left_until and r <= right_until:
                return False
            was_left, was_right = made.get(left), made.get(right)
            if was_left is None and was_right is None:
                return True
            if was_right is None or (was_left is not None and was_left[0] > was_right[0]):
                left_until, _, left = was_left
            else:
                right_until, right, _ = was_right

    def valid(self, token: int) -> bool:
        """The token encodes to itself."""
        known = self._valid.get(token)
        if known is None:
            made = self.made.get(token)
            known = made is None or (self.valid(made[1]) and self.valid(made[2])
                                     and self._border_holds(made[1], made[2], made[0]))
            self._valid[token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get(left << 20 | right)
        if known is None:
            if len(self.pairs) >= KEEP_PAIRS:
                self.pairs.clear()
            known = self.pairs[left << 20 | right] = self._border_holds(left, right, NEVER)
        return known

    # -- encoding --------------------------------------------------------------------------------

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word, given in byte characters."""
        text = word + END
        n = len(text)
        last: list[int | None] = [None] * (n + 1)       # last token of each prefix
        back = [0] * (n + 1)                              # the prefix before it
        known, test = self.pairs.get, self.compatible
        for stop, (token, size) in self.automaton.iter(text):
            stop += 1
            if last[stop] is not None:                    # the last token is unique
                continue
            start = stop - size
            if start:
                left = last[start]
                if left is None:
                    continue
                fits = known(left << 20 | token)
                if fits is None:
                    fits = test(left, token)
                if not fits:
                    continue
            last[stop], back[stop] = token, start
        ids, at = [], n
        while at:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]

    def words(self, text: str) -> list[str]:
        """The normalised words of a stretch without white space, in byte characters."""
        if max(text) > PLAIN:
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(
                self.library.normalizer.normalize_str(text))]
        text = unicodedata.normalize("NFC", text)
        text = text.lower() if text.isascii() else "".join([c.lower() for c in text])   # no context rules
        return ["".join([self.byte_chars[b] for b in w.encode()]) for w in WORDS.findall(text)]

    def piece_ids(self, piece: str) -> bytes:
        """Little-endian ids of a stretch without white space."""
        known = self.pieces.get(piece)
        if known is not None:
            return known
        ids: list[int] = []
        for part in (self._special.split(piece) if self._special else [piece]):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                for word in self.words(part):
                    known_ids = self.known_words.get(word)
                    if known_ids is None:
                        known_ids = self.word_ids(word)
                        if len(word) <= KEEP_PIECE_CHARS:
                            if len(self.known_words) >= KEEP_WORDS:
                                self.known_words.clear()
                            self.known_words[word] = known_ids
                    ids += known_ids
        out = np.array(ids, "<u4").tobytes()
        if len(piece) <= KEEP_PIECE_CHARS:
            if len(self.pieces) >= KEEP_PIECES:
                self.pieces.clear()
            self.pieces[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        get, slow = self.pieces.get, self.piece_ids
        return b"".join([get(p) or slow(p) for p in SPACE.split(text) if p])

    def decode(self, ids: bytes) -> str:
        """Token texts joined by spaces: the vocabulary file names no decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


@cache
def load(path: str) -> PrefixBpe:
    """One tokeniser a worker process."""
    return PrefixBpe(path)


def bpe(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded: one row per document.

    ``vocabulary`` names the file on every executor.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        enc = load(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = [enc.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array([enc.decode(i) for i in ids], pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
