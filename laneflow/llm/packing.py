"""Best-fit-decreasing packing into sequences of equal size: a capacity tree, and lower bounds for the number of bins."""

from __future__ import annotations

import numpy as np


class CapacityTree:
    """Open bins by the room left in them, over a segment tree of the rooms 0..size that says where one is open."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, bin_: int) -> None:
        own = self.bins[room]
        own.append(bin_)
        if len(own) == 1:
            at = room + self.leaves
            while at and not self.open[at]:
                self.open[at] = 1
                at >>= 1

    def take(self, need: int) -> tuple[int, int]:
        """The bin with the least room that is enough, and its room; (-1, 0) if there is none."""
        tree, at = self.open, need + self.leaves
        while not tree[at]:
            while at & 1:  # a right child: what follows hangs under a node further up
                at >>= 1
            if not at:
                return -1, 0
            at += 1
        while at < self.leaves:
            at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.leaves
        own = self.bins[room]
        bin_ = own.pop()
        if not own:
            tree[at] = 0
            at >>= 1
            while at and not (tree[2 * at] or tree[2 * at + 1]):
                tree[at] = 0
                at >>= 1
        return bin_, room


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, the longest placed first, each where the least room stays.

    lengths: 1 to size. Ties keep the order given. Offsets in a bin follow each other without gaps.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, count = CapacityTree(size), 0
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        bin_, room = tree.take(length)
        if bin_ < 0:
            bin_, room = count, size
            count += 1
        bins[i], offsets[i] = bin_, size - room
        if room > length:
            tree.put(room - length, bin_)
    return bins, offsets


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs: the best of several dual-feasible functions.

    The sum itself; for each a up to size/2 the function that makes pieces over size - a whole bins and drops those
    under a; and, for k from 1 to 20, the function that rounds (k + 1) * length / size down to k-ths unless it is whole.
    """
    if not len(lengths):
        return 0
    many = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    values = np.arange(size + 1, dtype=np.int64)
    n, total = np.cumsum(many), np.cumsum(many * values)
    half = size // 2
    a = np.arange(1, half + 1)
    big = n[-1] - n[size - a]
    middle = n[size - a] - n[half]
    room = middle * size - (total[size - a] - total[half])
    small = total[half] - total[a - 1]
    bounds = [-(-int(total[-1]) // size), int((big + middle + np.maximum(0, -(-(small - room) // size))).max(initial=0))]
    for k in range(1, 21):
        scaled = (k + 1) * values
        whole = scaled % size == 0
        # in units of 1 / (size * k)
        worth = np.where(whole, values * k, scaled // size * size)
        bounds.append(-(-int((worth * many).sum()) // (size * k)))
    return max(bounds)
