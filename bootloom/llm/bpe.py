"""Encoding many texts with a tokenizers file, each distinct piece once."""

from __future__ import annotations

import json
import os

import numpy as np

from .textops import hash_spans

BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
SOLID = np.zeros(256, bool)
SOLID[0x21:0x7F] = True
JOINED = 1 << 14
KEPT = 1 << 19
SLICE = 1 << 20  # bytes of text that are encoded at once, at some 40 bytes each
_loaded: dict[str, "Encoder"] = {}


def load(path: str) -> "Encoder":
    """One per worker process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


class Encoder:
    """Ids as the tokenizers library gives them, without added special tokens.

    Where the file is a plain byte-level BPE, a text may be cut before any white space that
    follows a printed character: no split pattern match and no special string reaches over
    such a place, so the pieces' ids are the text's ids. Each distinct piece of a batch is
    encoded once. Any other file encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.byte_level = bool(
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"]
            and not spec.get("normalizer") and model["type"] == "BPE" and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                         or any(c.isspace() for c in t["content"])) for t in spec["added_tokens"]))
        self.cache = Cache()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.size = size
        added = {t["id"]: len(t["content"].encode()) for t in spec["added_tokens"]}
        self.widths = np.array([added.get(i) or len(self.tokenizer.id_to_token(i) or "")
                                for i in range(size)], np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind one another, and their number by text."""
        out = self._pieces(data, offs) if self.byte_level and len(data) else None
        if out is not None:
            return out
        raw = data.tobytes()
        ids = self.whole([raw[a:b].decode() for a, b in zip(offs[:-1], offs[1:])])
        counts = np.array([len(x) for x in ids], np.int64)
        return np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum())), counts

    def _pieces(self, data, offs):
        blank = np.flatnonzero(BLANK[data])
        blank = blank[blank > 0]
        begins = np.zeros(len(data), bool)
        begins[blank[solid_before(data, blank)]] = True
        begins[offs[:-1][offs[1:] > offs[:-1]]] = True
        start = np.flatnonzero(begins)
        length = np.diff(np.append(start, len(data)))
        h = hash_spans(data, start, length)
        second = hash_spans(data, start, length, 1)
        order = np.argsort(h)
        fresh = np.append(True, h[order][1:] != h[order][:-1])
        index = order[fresh]
        inverse = np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(fresh) - 1
        known, slot = self.cache.find(h[index])
        known &= self.cache.second[slot] == second[index]
        new = index[~known]
        out = self._encode_new(data, start[new], length[new])
        if out is None or (second[index][inverse] != second).any():
            return None
        ids, counts = out
        pool = np.concatenate([self.cache.ids, ids])
        place = self.cache.begin[slot].astype(np.int64)
        size = self.cache.count[slot].astype(np.int64)
        place[~known] = len(self.cache.ids) + np.cumsum(counts) - counts
        size[~known] = counts
        each = size[inverse]
        ends = np.cumsum(each)
        every = pool[np.repeat(place[inverse] - ends + each, each) + np.arange(ends[-1])]
        upto = np.append(0, ends)[np.searchsorted(start, offs)]
        self.cache.add(h[new], second[new], counts, pool)
        return every, np.diff(upto)

    def _encode_new(self, data, start, length):
        """Ids of spans behind one another and their numbers. Spans that begin with white space
        and end in a printed character are encoded as one text, again cut before white space."""
        joins = BLANK[data[start]] & solid_before(data, start + length)
        counts = np.zeros(len(start), np.int64)
        pools = [np.zeros(0, np.uint32)] * 2
        first, rest = np.flatnonzero(joins), np.flatnonzero(~joins)
        if len(first):
            s, n = start[first], length[first]
            ends = np.cumsum(n)
            raw = data[np.repeat(s - ends + n, n) + np.arange(ends[-1])].tobytes()
            cut = np.searchsorted(ends, np.arange(0, ends[-1], JOINED), "left")
            cut = np.unique(np.append(ends[cut], ends[-1]))
            texts = [raw[a:b].decode() for a, b in zip(np.append(0, cut[:-1]), cut)]
            pools[0] = np.concatenate([np.array(x, np.uint32) for x in self.whole(texts)])
            reach = np.cumsum(self.widths[pools[0]])
            at = np.searchsorted(reach, ends, "left")
            if (reach[np.minimum(at, len(reach) - 1)] != ends).any():
                return None
            counts[first] = np.diff(np.append(-1, at))
        if len(rest):
            alone = self.whole([data[a:a + n].tobytes().decode()
                                for a, n in zip(start[rest], length[rest])])
            counts[rest] = [len(x) for x in alone]
            pools[1] = np.fromiter((i for x in alone for i in x), np.uint32)
        if not len(first) or not len(rest):
            return pools[0] if len(first) else pools[1], counts
        pool = np.concatenate(pools)
        begin = np.empty(len(start), np.int64)
        both = np.concatenate([first, rest])
        begin[both] = np.cumsum(counts[both]) - counts[both]
        ends = np.cumsum(counts)
        return pool[np.repeat(begin - ends + counts, counts) + np.arange(ends[-1])], counts


class Cache:
    """Ids of the first ``KEPT`` distinct pieces a worker has met, by two hashes."""

    def __init__(self):
        self.key = np.zeros(1, np.uint64)
        self.second = np.zeros(1, np.uint64)
        self.begin = np.zeros(1, np.uint32)
        self.count = np.zeros(1, np.uint32)
        self.ids = np.zeros(0, np.uint32)

    def find(self, h):
        """Whether sorted hashes are there, and a valid slot for each."""
        slot = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        return self.key[slot] == h, slot

    def add(self, h, second, counts, pool):
        """``pool`` holds the cache's ids and behind them those of the new pieces."""
        if len(self.key) + len(h) > KEPT or len(pool) > 8 * KEPT:
            return
        key = np.concatenate([self.key, h])
        order = np.argsort(key, kind="stable")
        begin = len(self.ids) + np.cumsum(counts) - counts
        self.begin = np.concatenate([self.begin, begin.astype(np.uint32)])[order]
        self.count = np.concatenate([self.count, counts.astype(np.uint32)])[order]
        self.second = np.concatenate([self.second, second])[order]
        self.key = key[order]
        self.ids = pool


def solid_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is surely no white space or control.

    Two- and three-byte white space begins with C2 or E1 to E3; other such characters that
    begin with E1 to E3 are left out too, which costs a cut, never a wrong one.
    """
    last, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    wide = (last >= 0x80) & ~((two == 0xC2) & ((last == 0x85) | (last == 0xA0))) & ~(
        (three >= 0xE1) & (three <= 0xE3))
    return SOLID[last] | wide
