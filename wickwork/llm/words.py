"""Words of UTF-8 texts as NumPy arrays, without one Python object per word.

Texts arrive as Arrow columns; they are worked through in slices of a bounded number of
bytes (`slices`), so the memory of a task follows `SLICE_BYTES` or its longest text, not
its partition. Hashes are 64-bit, equal in every process and run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_CODES = np.arange(256)
#: Bytes of words between blanks: all but 0x20 and 0x09 to 0x0D.
BLANK_WORDS = ~((_CODES == 0x20) | ((_CODES >= 0x09) & (_CODES <= 0x0D)))
#: Bytes of words of letters and digits: 0-9, A-Z, a-z and all of non-ASCII characters.
LETTER_WORDS = (
    ((_CODES >= 0x30) & (_CODES <= 0x39))
    | ((_CODES >= 0x41) & (_CODES <= 0x5A))
    | ((_CODES >= 0x61) & (_CODES <= 0x7A))
    | (_CODES >= 0x80)
)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)

#: Two primes under 2**31, each with a base. Products of residues fit 64 bits, and so do sums
#: of 2**33 residues; modulo a power of two, regular words such as Thue-Morse words would meet.
_FIELDS = ((2147483647, 1540483477), (2147483629, 1099087573))
_CACHED_POWERS = SLICE_BYTES + 4096


def _powers(base: int, prime: int, count: int) -> np.ndarray:
    out = np.ones(count, dtype=np.uint64)
    done = 1
    while done < count:
        more = out[: min(done, count - done)]
        out[done : done + len(more)] = more * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += len(more)
    return out


@lru_cache(maxsize=4)
def _cached_powers(base: int, prime: int) -> np.ndarray:
    return _powers(base, prime, _CACHED_POWERS)


def powers(base: int, prime: int, count: int) -> np.ndarray:
    """The first powers of a base in the field of a prime, from its power 0 on."""
    if count <= _CACHED_POWERS:
        return _cached_powers(base, prime)[:count]
    return _powers(base, prime, count)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    v = values ^ (values >> np.uint64(30))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v = v * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair; the empty range gives mix(0)."""
    out = np.zeros(len(starts), dtype=np.uint64)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    for prime, base in _FIELDS:
        field = np.uint64(prime)
        terms = values % field
        terms *= powers(base, prime, len(values))
        terms %= field
        np.cumsum(terms, dtype=np.uint64, out=sums[1:])
        part = (sums[ends] - sums[starts]) % field
        part *= powers(pow(base, -1, prime), prime, len(values) + 1)[starts]
        out = (out << np.uint64(31)) | (part % field)
    return mix(out)


class Words:
    """The words of some texts: byte ranges, and the first word of each text."""

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray, lower: bool):
        data, offsets = text_bytes(texts)
        self.data = LOWER[data] if lower else data
        inside = word_bytes[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][filled], offsets[1:][filled] - 1
        begins[first], ends[last] = inside[first], inside[last]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        #: Words of text i: first[i] to first[i + 1].
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        lengths = (self.ends - self.starts).astype(np.uint64)
        return mix(range_hashes(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends) + lengths)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, nulls as empty, and the offsets of each."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, raw, data = texts.buffers()
    offsets = np.frombuffer(raw, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def gram_starts(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first word of every run of `size` words that lies in one text, and runs per text."""
    runs = np.maximum(words.counts - size + 1, 0)
    starts = np.arange(int(runs.sum())) + np.repeat(
        words.first[:-1] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs
    )
    return starts.astype(np.int64), runs


def slices(
    batches: Iterator[pa.RecordBatch],
    texts: Callable[[pa.RecordBatch], pa.Array],
    limit: int = SLICE_BYTES,
    rows: int | None = None,
) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of at most `limit` bytes of text and `rows` rows, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(texts(batch))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            upto = max(at + 1, min(upto, batch.num_rows, at + (rows or batch.num_rows)))
            yield batch.slice(at, upto - at)
            at = upto
