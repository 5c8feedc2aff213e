"""Words and their hashes for a whole Arrow batch of texts at a time, in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from ..functions.memory import give_back

U = np.uint64
SPACE = np.ones(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower case.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

LONG_WORD = 256
SEEDS = (U(0x9AE16A3B2F90404F), U(0xC949D7C7509E6557))
M1, M2 = U(0x9FB21C651E98DF25), U(0xD6E8FEB86659FD93)


def slices(batches, column: str, most: int = 2 << 20, rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """The batches put together or cut to about ``most`` bytes of text and not much over ``rows``
    rows; a longer text is alone. What a worker frees goes back to the system, as workers stay."""
    give_back()
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(np.diff(_offsets(batch.column(column)))) if batch.num_rows else []
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = int(np.searchsorted(ends, base + most - size, "right"))
            if end <= begin and not held:
                end = begin + 1
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(ends[end - 1] - base)
            if end < batch.num_rows or size >= most or sum(x.num_rows for x in held) >= rows:
                yield _one(held)
                held, size = [], 0
            begin = max(begin, end)
    if held:
        yield _one(held)
    held = batch = None
    give_back()


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)


def _offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    raw = np.frombuffer(array.buffers()[1], kind, len(array) + 1 + array.offset)
    return raw[array.offset:].astype(np.int64)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind one another, and where each begins and ends."""
    if array.null_count:
        array = array.fill_null("")
    offs = _offsets(array)
    data = array.buffers()[2]
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), offs - offs[0]
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


@dataclass
class Words:
    start: np.ndarray   # byte offsets
    length: np.ndarray
    doc: np.ndarray     # row of the batch
    first: np.ndarray   # word offsets by row, one more than rows

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def find_words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray = SPACE) -> Words:
    """Runs of bytes that are ``inside``; none reaches over the end of a text."""
    n = len(offs) - 1
    if not len(data):
        zero = np.zeros(0, np.int64)
        return Words(zero, zero, zero, np.zeros(n + 1, np.int64))
    word = inside[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edge = offs[1:-1][offs[1:-1] < len(data)]
    begins[edge] = word[edge]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    edge = edge[edge > 0] - 1
    stops[edge] = word[edge]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(stops) + 1 - start
    first = np.searchsorted(start, offs)
    first[-1] = len(start)
    return Words(start, length, np.repeat(np.arange(n), np.diff(first)), first)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h *= M1
    h ^= h >> U(29)
    h *= M2
    h ^= h >> U(32)
    return h


def hash_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans; ``which`` picks one of two independent ones."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    h = np.full(len(start), SEEDS[which], np.uint64)
    h ^= length.astype(np.uint64) * M2
    live = np.arange(len(start))
    long = np.flatnonzero(length > LONG_WORD)
    rest = length
    at = start
    if len(long):
        live = np.flatnonzero(length <= LONG_WORD)
        rest, at = length[live], start[live]
    done = 0
    while len(live):
        left = np.minimum(rest - done, 8)
        block = eight[at + done] & (U(0xFFFFFFFFFFFFFFFF) >> ((8 - left).astype(np.uint64) << U(3)))
        h[live] = mix(h[live] ^ block)
        done += 8
        more = rest > done
        live, rest, at = live[more], rest[more], at[more]
    view = memoryview(data)
    for i in long:
        h[i] = xxhash.xxh3_64_intdigest(view[start[i]:start[i] + length[i]], seed=which)
    return h


def ngrams(h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hashes of k consecutive word hashes: entry i covers words i to i + k - 1."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    odd = SEEDS[which] | U(1)
    for i in range(k):
        out *= odd
        out += h[i:i + n]
    return mix(out)


def ngram_starts(words: Words, k: int) -> np.ndarray:
    """Which entries of ``ngrams`` lie within one text."""
    n = len(words.doc) - k + 1
    return np.flatnonzero(words.doc[:n] == words.doc[k - 1:]) if n > 0 else np.zeros(0, np.int64)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
