"""Words, lines and 64-bit hashes of whole Arrow text columns, with numpy.

A column is walked in chunks of about ``CHUNK_BYTES``; a chunk ends at a text's
end, so no text is ever cut, and one longer than that is a chunk of its own.
Memory is about 60 bytes for each byte of a chunk. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: White space between words: the space and the five controls from tab to return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IN_WORD = np.ones(256, bool)
IN_WORD[list(SPACES)] = False

_BASE = 0x9E3779B97F4A7C15
_MODULUS = 1 << 64


class Chunk(NamedTuple):
    """Texts ``first`` to ``last`` (exclusive) of a column, end to end."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of ``column`` in order, as runs of UTF-8 bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = column.cast(pa.large_binary())
    if not len(wide):
        return
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    body = wide.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(wide):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(wide))
        yield Chunk(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each longest run of true bytes within one text."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[0] = False
    before[filled] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1] = False
    after[filled[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, owners(starts, offsets)


def owners(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of the text that holds each position."""
    return np.searchsorted(offsets, positions, "right") - 1


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word of a chunk."""
    return spans(IN_WORD[chunk.data], chunk.offsets)


def _power(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash modulo 2**64; entry i covers the first i values."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; equal content gives equal hashes wherever it stands."""
    inverse = _power(pow(_BASE, -1, _MODULUS), len(prefix))
    raw = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of several, in order."""
    out = parts[0]
    for part in parts[1:]:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + part)
    return out
