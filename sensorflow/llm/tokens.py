"""Whole-text encoding with a public tokenizer, shared by the operators that need token ids.

A text falls into units, words with the white space before them, that no token
can cross, so its ids are the ids of its units in a row. Units repeat a lot:
each Python worker keeps their ids in a table of arrays under 64-bit hashes,
which is emptied when it holds ``CACHE_UNITS`` units, so memory is bounded and
results don't depend on it. Texts whose units can't be told apart safely
(runs of white space or unusual kinds of it, special tokens' strings) are
encoded whole by the library.

With a vocabulary of lower-cased words (``FINE``), letters and signs next to
each other are units of their own and A-Z count as a-z, so there are fewer
units; new units of letters alone are encoded many in one text and told apart
by the mark of a word's last token.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa

from sensorflow.llm import textbatch as tb
from sensorflow.llm.textbatch import ranges

CACHE_UNITS = 800_000
U = np.uint64

_encoders: dict[str, "UnitEncoder"] = {}

_SEPARATOR = {"spaced": np.isin(np.arange(256), [10, 32]), "words": tb.IS_SPACE}
#: Control characters that some definitions of white space include.
_ODD = np.isin(np.arange(256), [0x1C, 0x1D, 0x1E, 0x1F])
#: White space outside ASCII: lead byte -> the pairs (second byte, range of third bytes or None).
_WIDE = {0xC2: [(0x85, None), (0xA0, None)], 0xE1: [(0x9A, (0x80, 0x80))], 0xE2: [(0x80, (0x80, 0x8A)), (0x80, (0xA8, 0xAF)), (0x81, (0x9F, 0x9F))],
         0xE3: [(0x80, (0x80, 0x80))]}

#: Pre-tokenization under which letters and signs other than the apostrophe never share a token.
FINE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER, _SIGN = 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = _SIGN
#: Units encoded in one text.
JOINED = 64


def _classes(raw: np.ndarray) -> np.ndarray:
    """Of every byte, whether it is of a letter up to U+00FF, an ASCII sign other than the apostrophe, or anything else."""
    out = _CLASS[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]  # the signs of multiplication and division
    out[lead] = out[lead + 1] = _LETTER
    return out


def _borders(cls: np.ndarray) -> np.ndarray:
    """Where a letter follows a sign or a sign a letter."""
    return np.flatnonzero((cls[1:] | cls[:-1]) == (_LETTER | _SIGN)) + 1


def _folded(raw: np.ndarray) -> np.ndarray:
    """A-Z as a-z, except before bytes that may begin a combining mark: some compose with small letters alone."""
    out = tb.LOWER[raw]
    mark = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] != 0xC3))
    out[mark] = raw[mark]
    return out


class _Table:
    """An open-addressing map from non-zero 64-bit keys to consecutive numbers."""

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.keys, self.nums = np.zeros(1 << bits, U), np.zeros(1 << bits, np.int32)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for unknown ones."""
        out = np.full(len(key), -1, np.int64)
        todo, slot = np.arange(len(key)), (key >> U(64 - self.bits)).astype(np.int64)
        while len(todo):
            seen = self.keys[slot]
            hit = seen == key[todo]
            out[todo[hit]] = self.nums[slot[hit]]
            go = ~hit & (seen != 0)
            todo, slot = todo[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, key: np.ndarray) -> None:
        """Number distinct unknown keys from ``n`` on."""
        if 2 * (self.n + len(key)) > len(self.keys):
            at = np.flatnonzero(self.keys)
            keys, nums = self.keys[at], self.nums[at]
            self.bits = max(self.bits + 1, int(2 * (self.n + len(key))).bit_length())
            self.keys, self.nums = np.zeros(1 << self.bits, U), np.zeros(1 << self.bits, np.int32)
            self._put(keys, nums)
        self._put(key, np.arange(self.n, self.n + len(key), dtype=np.int32))
        self.n += len(key)

    def _put(self, key: np.ndarray, num: np.ndarray) -> None:
        slot = (key >> U(64 - self.bits)).astype(np.int64)
        while len(key):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            took = free[first]
            self.keys[slot[took]], self.nums[slot[took]] = key[took], num[took]
            rest = np.ones(len(key), bool)
            rest[took] = False
            key, num, slot = key[rest], num[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)


class UnitEncoder:
    def __init__(self, path: str, cache_units: int = CACHE_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        # the parts alone: the whole description has the vocabulary in it
        pre, norm = (x if x is None else json.loads(x.__getstate__()) for x in (self.lib.pre_tokenizer, self.lib.normalizer))
        pre = pre or {}
        self.special = [t.content.encode() for t in self.lib.get_added_tokens_decoder().values()]
        self.last = None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            self.kind = "spaced"  # a unit is a word with the one space or line break before it
        elif (norm or {}).get("type") == "Sequence" and [x["type"] for x in norm["normalizers"]] == ["NFC", "Replace", "Lowercase"] \
                and pre.get("type") == "Sequence" and pre["pretokenizers"][0].get("invert") and pre["pretokenizers"][0].get("behavior") == "Removed":
            self.kind = "words"  # white space only separates
            mark = getattr(self.lib.model, "end_of_word_suffix", None)
            if mark and pre["pretokenizers"][0]["pattern"] == {"Regex": FINE} and pre["pretokenizers"][1:] == [
                    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]:
                vocab = self.lib.get_vocab()
                self.last = np.zeros(max(vocab.values()) + 1, bool)  # whether an id ends a word
                self.last[[i for t, i in vocab.items() if t.endswith(mark)]] = True
        else:
            self.kind = "whole"
        self.most = cache_units
        self.reset()

    def reset(self):
        self.table = _Table()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros((1 << 12) + 1, np.int64)  # unit i: flat[begin[i]: begin[i + 1]]
        self.units = 0

    def _raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        f = getattr(self.lib, "encode_batch_fast", self.lib.encode_batch)
        ids = [x.ids for x in f(texts, add_special_tokens=False)]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens

    def _raw_units(self, texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of units; ``letters`` marks those of letters alone, each of which is one word."""
        pick, other = np.flatnonzero(letters), np.flatnonzero(~letters)
        own = [texts[i] for i in pick.tolist()]
        groups = [own[a: a + JOINED] for a in range(0, len(own), JOINED)]
        ids, size = self._raw([" ".join(g) for g in groups])
        end = np.concatenate([[0], np.cumsum(self.last[ids])])[np.concatenate([[0], np.cumsum(size)])]
        if not np.array_equal(np.diff(end), [len(g) for g in groups]):  # a word without a last token
            return self._raw(texts)
        rest, rest_lens = self._raw([texts[i] for i in other.tolist()])
        lens = np.empty(len(texts), np.int64)
        lens[pick], lens[other] = np.diff(np.flatnonzero(self.last[ids]), prepend=-1), rest_lens
        begin = np.cumsum(lens) - lens
        out = np.empty(int(lens.sum()), np.uint32)
        out[ranges(begin[pick], lens[pick])], out[ranges(begin[other], lens[other])] = ids, rest
        return out, lens

    def _append(self, ids: np.ndarray, lens: np.ndarray):
        used = int(self.begin[self.units])
        need = used + len(ids)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need, 2 * len(self.flat)) - len(self.flat), np.uint32)])
        self.flat[used: need] = ids
        if self.units + len(lens) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(max(len(self.begin), len(lens)), np.int64)])
        self.begin[self.units + 1: self.units + len(lens) + 1] = used + np.cumsum(lens)
        self.units += len(lens)

    def _unsafe(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Texts that have to be encoded whole."""
        if self.kind == "whole":
            return np.arange(len(off) - 1)
        odd = _ODD.copy()
        if self.kind == "spaced":
            odd[[0x09, 0x0B, 0x0C, 0x0D]] = True
        bad = [np.flatnonzero(odd[raw])]
        after = np.append(raw[1:], 0)
        for lead, follow in _WIDE.items():
            at = np.flatnonzero(raw == lead)
            third = np.append(after[1:], 0)[at] if len(at) else at
            for second, span in follow:
                ok = after[at] == second
                bad.append(at[ok if span is None else ok & (third >= span[0]) & (third <= span[1])])
        for lead in {s[:2] for s in self.special}:
            bad.append(np.flatnonzero((raw == lead[0]) & ((after == lead[1]) if len(lead) > 1 else True)))
        if self.kind == "spaced":
            space = _SEPARATOR["spaced"][raw]
            last = off[1:][off[1:] > off[:-1]] - 1
            ends = np.zeros(len(raw), bool)
            ends[last] = True
            bad.append(np.flatnonzero(space & (ends | np.append(space[1:], False))))  # a run of white space, or some at the end
        return np.unique(np.searchsorted(off, np.concatenate(bad), side="right") - 1)

    def encode_bytes(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and n + 1 offsets of texts given as UTF-8 bytes and offsets."""
        if self.units > self.most:
            self.reset()
        n = len(off) - 1
        whole = self._unsafe(raw, off)
        kind = "words" if self.kind == "whole" else self.kind
        fine = self.last is not None
        if fine:
            cls = _classes(raw)
            start, end, h, first = tb.words(_folded(raw), off, _SEPARATOR[kind], fold=False, cuts=_borders(cls))
        else:
            start, end, h, first = tb.words(raw, off, _SEPARATOR[kind], fold=False)
        if kind == "spaced":
            before = np.concatenate([np.zeros(1, np.uint8), raw])
            before[off[:-1]] = 0  # nothing comes before a text
            before = before[start]
            h = tb.mix(h + before.astype(U) * U(0x9E6C63D0876A9A35))
        h |= U(1)
        count = np.diff(first)
        if len(whole):
            drop = np.zeros(n, bool)
            drop[whole] = True
            keep = ~np.repeat(drop, count)
            start, end, h = start[keep], end[keep], h[keep]
            before = before[keep] if kind == "spaced" else None
            count = np.where(drop, 0, count)
        elif kind != "spaced":
            before = None
        at = self.table.find(h)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            key, which, inv = np.unique(h[miss], return_index=True, return_inverse=True)
            data = raw.tobytes()
            pick = miss[which]
            if before is None:
                texts = [data[a:b].decode() for a, b in zip(start[pick].tolist(), end[pick].tolist())]
            else:
                lead = (start[pick] - (before[pick] > 0)).tolist()
                texts = [data[a:b].decode() for a, b in zip(lead, end[pick].tolist())]
            at[miss] = self.table.n + inv
            self.table.add(key)
            if fine:
                odd = np.concatenate([[0], np.cumsum(cls != _LETTER)])
                self._append(*self._raw_units(texts, odd[end[pick]] == odd[start[pick]]))
            else:
                self._append(*self._raw(texts))
        lens = self.begin[at + 1] - self.begin[at]
        ids = self.flat[ranges(self.begin[at], lens)]
        total = np.concatenate([[0], np.cumsum(lens)])
        cut = np.concatenate([[0], np.cumsum(count)])
        out = total[cut]
        if not len(whole):
            return ids, out
        data = raw.tobytes()
        own, size = self._raw([data[off[i]: off[i + 1]].decode() for i in whole])
        lens_of = np.diff(out)
        lens_of[whole] = size
        new = np.concatenate([[0], np.cumsum(lens_of)])
        result = np.empty(new[-1], np.uint32)
        mine = np.zeros(n, bool)
        mine[whole] = True
        result[ranges(new[:-1][mine], lens_of[mine])] = own
        result[ranges(new[:-1][~mine], lens_of[~mine])] = ids
        return result, new

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and n + 1 offsets; a null is an empty text."""
        return self.encode_bytes(*tb.text_buffers(pa.array(texts, pa.large_string())))


def encoder(path: str) -> UnitEncoder:
    """This process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


def with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text."""
    n = len(off) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    new = off + np.arange(n + 1)
    out[ranges(new[:-1], np.diff(off))] = ids
    return out, new


def encoded_slices(col: pa.Array, vocabulary: str, end_id: int):
    """A text column slice by slice: (first row, last row, ids with ends, offsets)."""
    raw, off = tb.text_buffers(col)
    for a, z in tb.slices(off):
        yield a, z, *with_end(*encoder(vocabulary).encode_bytes(raw[off[a]: off[z]], off[a: z + 1] - off[a]), end_id)
