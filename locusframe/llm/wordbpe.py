"""Fast exact ids of a word-level BPE tokenizer file.

The tokenizer lower-cases, drops white space and merges inside pre-tokens only, so
equal pre-tokens have equal ids. Pre-tokens are cut and hashed in numpy; each
distinct one is encoded once by the ``tokenizers`` library and kept in a bounded
cache. Texts whose pre-tokens this cannot cut safely (other scripts, combining
marks, contractions, special-token strings) are encoded whole by the library.
"""

from __future__ import annotations

import os

import numpy as np

from .common import BYTE_VALUES, U64, distinct, prefix_hashes, ragged, span_hashes

CACHE_WORDS = 1_200_000
#: Byte classes of the pre-tokenizer's pattern (0 space, 1 letter, 2 number, 3 other).
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = _CLASS[0xC3:0xC6] = 1
_AFTER_C2 = np.full(256, 3, np.uint8)
_AFTER_C2[[0x85, 0xA0]] = 0
_AFTER_C2[[0xAA, 0xB5, 0xBA]] = 1
_AFTER_C2[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = 2
_CONTRACTED = np.zeros(256, bool)
_CONTRACTED[list(b"strvmldSTRVMLD")] = True


class WordBpe:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, U64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and the number of each."""
        parts, counts = [], []
        for a in range(0, len(words), 4000):
            part = words[a : a + 4000]
            ids = self.whole(" ".join(part))
            ends = np.flatnonzero(self.ends_word[ids])
            if len(ends) == len(part) and len(ids) == ends[-1] + 1:
                n = np.diff(ends, prepend=-1)
            else:
                each = [self.whole(w) for w in part]
                ids, n = np.concatenate(each), np.array([len(x) for x in each])
            parts.append(ids)
            counts.append(n)
        return np.concatenate(parts), np.concatenate(counts)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """keys: sorted and not yet known."""
        if len(self.keys) + len(keys) > CACHE_WORDS:
            raise OverflowError
        ids, n = self._encode_words(words)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(n) - n
        self.used += len(ids)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, at)
        self.n = np.insert(self.n, where, n)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def rows(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of every text of a chunk."""
        n_rows, size = len(offsets) - 1, len(raw)
        if not size:
            return [np.zeros(0, np.uint32) for _ in range(n_rows)]
        cls = _CLASS[raw]
        lead2 = np.flatnonzero(raw[:-1] == 0xC2)
        cls[lead2] = _AFTER_C2[raw[lead2 + 1]]
        odd3 = np.flatnonzero((raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7)))
        cls[odd3] = 3
        cont = (raw & 0xC0) == 0x80
        at = np.flatnonzero(cont)
        cls[at] = cls[at - 1]
        hard = raw >= 0xC6
        hard[:-1] |= (raw[:-1] == 0xC4) & (raw[1:] == 0xB0)
        hard[:-1] |= (raw[:-1] == 0x27) & _CONTRACTED[raw[1:]]
        hard[:-1] |= (raw[:-1] == 0x3C) & (raw[1:] == 0x7C)
        slow = np.diff(np.concatenate([[0], np.cumsum(hard)])[offsets]) > 0

        edge = np.zeros(size + 1, bool)
        edge[offsets] = True
        first = edge[:size].copy()
        first[1:] |= (cls[1:] != cls[:-1]) | ((cls[1:] == 2) & ~cont[1:])
        first &= cls != 0
        stop = edge[1:].copy()
        stop[:-1] |= first[1:] | (cls[1:] == 0)
        stop &= cls != 0
        starts, ends = np.flatnonzero(first), np.flatnonzero(stop) + 1
        row = np.searchsorted(offsets, starts, "right") - 1
        if slow.any():
            keep = ~slow[row]
            starts, ends, row = starts[keep], ends[keep], row[keep]
        keys, index, inverse = distinct(span_hashes(prefix_hashes(BYTE_VALUES[raw]), starts, ends))
        for _ in range(2):
            new = ~self._known(keys)
            if not new.any():
                break
            s, e, data = starts[index[new]], ends[index[new]], raw.tobytes()
            try:
                self._learn(keys[new], [data[i:j].decode() for i, j in zip(s.tolist(), e.tolist(), strict=True)])
            except OverflowError:
                self._reset()
                if len(keys) > CACHE_WORDS:
                    slow[:] = True
                    break
        if len(keys) and not slow.all():
            where = np.searchsorted(self.keys, keys)[inverse]
            n = self.n[where]
            flat = self.pool[ragged(self.at[where], n)]
            bounds = np.concatenate([[0], np.cumsum(np.bincount(row, n, n_rows).astype(np.int64))])
        else:
            flat, bounds = np.zeros(0, np.uint32), np.zeros(n_rows + 1, np.int64)
        out = [flat[bounds[i] : bounds[i + 1]] for i in range(n_rows)]
        for i in np.flatnonzero(slow):
            out[i] = self.whole(raw[offsets[i] : offsets[i + 1]].tobytes().decode())
        return out
