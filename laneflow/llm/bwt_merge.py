"""Burrows-Wheeler transforms of shards of strings, merged by refining their interleave."""

from __future__ import annotations

import numpy as np

from laneflow.llm.fm_index import suffix_order

END, BREAK = 0, 1


class Shard:
    """Some strings one after the other with a BREAK behind each and an END; its suffix order, transform and steps back.

    before: for each place of the order the place of the suffix one symbol earlier (the LF mapping).
    """

    def __init__(self, body: np.ndarray, sizes: np.ndarray, depth: int):
        kind = np.uint8 if int(body.max(initial=0)) <= 253 else np.uint16
        at = np.arange(len(body)) + np.repeat(np.arange(len(sizes)), sizes)
        self.symbols = np.full(len(body) + len(sizes) + 1, BREAK, dtype=kind)
        self.symbols[at] = body.astype(kind) + kind(2)
        self.symbols[-1] = END
        self.order = suffix_order(self.symbols, depth).astype(np.int32)
        self.bwt = self.symbols[self.order - 1]
        self.before = np.empty(len(self.bwt), dtype=np.int32)
        self.before[np.argsort(self.bwt, kind="stable")] = np.arange(len(self.bwt), dtype=np.int32)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the shards' suffixes (counted through all shards) that share their first `depth` symbols with another one,
    in merged order, and the block of each: a repeated interval of the merged order.

    The interleave starts as shard after shard, in one block. A round reads the merged transform through it, deals the
    entries out by symbol, in order, and steps back in each shard: so suffixes come to stand by one symbol more, and each
    shard's own order is never sorted again. Two neighbours stay in one block while their symbols and the blocks of
    what follows agree: their common prefix is as long as the rounds. A block of one is settled and leaves, and so do
    suffixes that begin before their string.
    """
    transform = np.concatenate([s.bwt for s in shards])
    base = np.cumsum([0, *[len(s.bwt) for s in shards[:-1]]])
    before = np.concatenate([s.before + b for s, b in zip(shards, base)]).astype(np.int32)
    place, block = np.arange(len(transform), dtype=np.int32), np.zeros(len(transform), dtype=np.int32)
    for _ in range(depth):
        symbol = transform[place]
        inside = symbol > BREAK
        place, block, symbol = place[inside], block[inside], symbol[inside]
        dealt = np.argsort(symbol, kind="stable")
        symbol, was = symbol[dealt], block[dealt]
        first = np.ones(len(place) + 1, dtype=bool)
        first[1:-1] = (symbol[1:] != symbol[:-1]) | (was[1:] != was[:-1])
        shared = ~(first[:-1] & first[1:])
        place = before[place[dealt[shared]]]
        block = np.cumsum(first[:-1][shared], dtype=np.int32)
        if not len(place):
            break
    return place, block


def least_owners(body: np.ndarray, sizes: np.ndarray, owners: np.ndarray, length: int, shard_bytes: int) -> np.ndarray:
    """For each string (rows) and start (columns) the least owner of a string that holds the `length` bytes from there.

    owners: one number for each string. Starts with fewer bytes left have the largest number.
    """
    cuts, held = [0], 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > shard_bytes:
            cuts.append(i)
            held = 0
        held += size
    cuts.append(len(sizes))
    ends = np.cumsum(sizes)
    shards, strings, starts = [], [], []
    for a, b in zip(cuts, cuts[1:]):
        begin = ends[a] - sizes[a]
        own = Shard(body[begin : ends[b - 1]], sizes[a:b], length)
        string = np.append(np.repeat(np.arange(a, b, dtype=np.int32), sizes[a:b] + 1), 0)
        first = np.cumsum(sizes[a:b] + 1) - (sizes[a:b] + 1)
        inside = np.arange(len(string), dtype=np.int32) - np.append(np.repeat(first, sizes[a:b] + 1), 0).astype(np.int32)
        shards.append(own), strings.append(string[own.order]), starts.append(inside[own.order])
    place, block = merge(shards, length)
    out = np.where(np.arange(int(sizes.max()) - length + 1) <= (sizes - length)[:, None], owners[:, None], np.iinfo(np.int64).max)
    if len(place):
        string, start = np.concatenate(strings)[place], np.concatenate(starts)[place]
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        least = np.minimum.reduceat(owners[string], edges)
        out[string, start] = np.repeat(least, np.diff(np.r_[edges, len(place)]))
    return out
