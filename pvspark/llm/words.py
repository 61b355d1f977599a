"""Splitting whole texts into ASCII-lower-cased words, a batch at a time, inside Spark's Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
#: A-Z become a-z; ASCII digits, letters and every byte of a non-ASCII character stay; the rest is white space.
_TABLE = bytes(ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def slices(batches, rows: int, column: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Cut and join Arrow batches into pieces of at most ``rows`` rows and, unless a single row has more,
    ``chars`` bytes in the string column ``column``."""
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in batches:
        sizes = [s or 0 for s in pa.compute.binary_length(batch.column(column)).to_pylist()]
        start = 0
        for i, s in enumerate(sizes):
            if n and (n >= rows or size + s > chars):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.concat_batches(held)
                held, start, n, size = [], i, 0, 0
            n += 1
            size += s
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)
