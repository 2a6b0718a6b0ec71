"""Token ids of whole texts inside tasks, with each distinct word encoded once per task and memory bound."""

from __future__ import annotations

import sys
import types

import numpy as np
import regex
from tokenizers import Tokenizer

from laneflow.llm.arrays import U64, span_hashes

#: Words kept in memory by a task; beyond it the task starts over with an empty store.
MOST_WORDS = 1_000_000

# Kinds of characters that the byte-level pre-tokenizer tells apart.
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3


def _kinds() -> np.ndarray:
    """The kind of each code point, from Unicode's classes."""
    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            a, b = found.span()
            skip = lambda i: i if i < 0xD800 else i + 0x800
            kinds[skip(a) : skip(b - 1) + 1] = kind
    return kinds


def encoder(path: str) -> "WordEncoder":
    """This process's encoder for a vocabulary file: tasks that follow each other share its words."""
    held = sys.modules.setdefault("_laneflow_encoders", types.ModuleType("_laneflow_encoders")).__dict__
    if path not in held:
        held[path] = WordEncoder(path)
    return held[path]


class WordEncoder:
    """Ids of texts, equal to those of a byte-level BPE tokenizer that splits texts by
    `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`.

    Words are cut by array operations; the tokenizer gets each distinct word once. Special tokens written in a text are
    ordinary text.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kinds = _kinds()
        self._clear()

    def _clear(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and n + 1 offsets into them. flat: valid UTF-8."""
        starts, ends = self._words(flat, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        hashes = span_hashes(flat, starts, ends)
        keys, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        places = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[places] == keys if len(self.keys) else np.zeros(len(keys), bool)
        if not known.all():
            if len(self.keys) + len(keys) > MOST_WORDS:
                self._clear()
                known = np.zeros(len(keys), bool)
            self._learn(flat, keys[~known], starts[at[~known]], ends[at[~known]])
            places = np.searchsorted(self.keys, keys)
        first, size = self.starts[places][back], self.sizes[places][back]
        total = np.cumsum(size)
        ids = self.ids[np.arange(total[-1]) + np.repeat(first - (total - size), size)]
        return ids, np.r_[0, total][np.searchsorted(starts, offsets)]

    def _learn(self, flat: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        sizes, learned = [], []
        # some words at a time: the tokenizer's answers are far larger than the ids
        for at in range(0, len(keys), 8192):
            words = [flat[a:b].tobytes().decode() for a, b in zip(starts[at : at + 8192], ends[at : at + 8192])]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            learned.append(np.fromiter((i for x in found for i in x), np.uint32, int(sizes[-1].sum())))
        sizes, learned = np.concatenate(sizes), np.concatenate(learned)
        all_keys = np.concatenate([self.keys, keys])
        order = np.argsort(all_keys)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.ids = np.concatenate([self.ids, learned])
        self.keys = all_keys[order]

    def _words(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts and ends of the pre-tokenizer's words; words don't cross rows."""
        if not len(flat):
            return (np.zeros(0, np.int64),) * 2
        head = (flat & 0xC0) != 0x80  # first byte of a character
        place = np.flatnonzero(head)
        if len(place) == len(flat):
            points = flat
        else:
            points = np.frombuffer(flat.tobytes().decode().encode("utf-32-le"), np.uint32)
        kind = self.kinds[points]
        n = len(points)
        edge = np.zeros(n + 1, dtype=bool)  # a row starts here
        edge[np.searchsorted(place, offsets)] = True
        space = kind == _SPACE
        change = np.ones(n, dtype=bool)
        change[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
        # the last of several white space characters before a word stands alone, and a blank belongs to the word
        last = space & np.r_[change[1:], True] & ~edge[1:]
        blank = last & (points == 32)
        start = change | last
        after = np.r_[False, blank[:-1]]
        start &= ~after
        # contractions: an apostrophe that starts a word with the letters behind it
        self._contractions(points, kind, edge, start, after)
        starts = place[np.flatnonzero(start)]
        return starts, np.r_[starts[1:], len(flat)]

    @staticmethod
    def _contractions(points: np.ndarray, kind: np.ndarray, edge: np.ndarray, start: np.ndarray, after: np.ndarray) -> None:
        """Mends start where 's 't 're 've 'm 'll 'd begin at the start of a word."""
        n = len(points)
        for at in np.flatnonzero((points == 39) & start):
            row_end = at + 1
            while row_end < min(n, at + 3) and not edge[row_end]:
                row_end += 1
            tail = "".join(chr(points[i]) for i in range(at + 1, row_end))
            size = 2 if tail[:2] in ("re", "ve", "ll") else 1 if tail[:1] in ("s", "t", "m", "d") else 0
            if size:
                start[at + 1 : at + 1 + size] = False
                end = at + 1 + size
                if end < n and not edge[end]:
                    # what follows begins a word of its own
                    start[end] = True
