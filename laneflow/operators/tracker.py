"""Track assignment: which boxes of successive frames are the same vehicle.

A table of boxes is walked in blocks of frames, all at once. A block starts from a guess: what a short walk over the
frames before it ends with. Where the block before it ends with something else, it is walked again from there, until all
seams agree; then every block has started from what one long walk would have had, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.config import MAX_LOST_FRAMES, MAX_MATCH_PX, WALK_FRAMES, WARM_UP_FRAMES
from laneflow.operators.blocks import BLOCK, block_of, running_total
from laneflow.session import stored

FEED = ("camera_name", "side")
_KEYS = (*FEED, BLOCK)

# Of a walked block: the tracks it starts with and ends with, in the order of their ids; the own numbers of the latter
# (those it started with come first, then its new ones); how many are new; and the positions by own number.
_STATE = pa.list_(pa.struct([("cx", pa.int32()), ("cy", pa.int32()), ("lost", pa.int32())]))
_PLACES = pa.list_(pa.struct([("track", pa.int64()), ("frame_id", pa.int64()), ("cx", pa.int32()), ("cy", pa.int32()), ("coasting", pa.bool_())]))
_STATE_SQL = "array<struct<cx:int,cy:int,lost:int>>"
_WALKED = (f"camera_name string, side string, {BLOCK} long, round int, last_box long, begin {_STATE_SQL}, end {_STATE_SQL}, own array<long>, "
           "fresh long, places array<struct<track:long,frame_id:long,cx:int,cy:int,coasting:boolean>>")


@dataclass
class Tracks:
    """Active tracks of one side of one camera, in the order of their ids."""

    next_id: int = 0
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    points: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.int64))
    lost: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def advance(self, boxes: np.ndarray, max_dist: float, max_lost: int) -> None:
        """One frame: nearest pairs first, the rest of the tracks wait, the rest of the boxes are new."""
        track_of = nearest_pairs(self.points, boxes, max_dist)
        old = track_of >= 0
        self.lost += 1
        self.points[track_of[old]] = boxes[old]
        self.lost[track_of[old]] = 0
        stay = self.lost <= max_lost
        fresh = boxes[~old]
        new_ids = np.arange(self.next_id, self.next_id + len(fresh), dtype=np.int64)
        self.next_id += len(fresh)
        self.ids = np.concatenate([self.ids[stay], new_ids])
        self.points = np.concatenate([self.points[stay], fresh])
        self.lost = np.concatenate([self.lost[stay], np.zeros(len(fresh), np.int64)])


def nearest_pairs(points: np.ndarray, boxes: np.ndarray, max_dist: float) -> np.ndarray:
    """For each box the index of its track, or -1.

    Pairs are settled by distance; equal distances by track, then by box. The
    squared distance of whole pixels is exact and orders pairs like the distance.
    """
    track_of = np.full(len(boxes), -1, np.int64)
    if not len(points) or not len(boxes):
        return track_of
    gap = points[:, None, :] - boxes[None, :, :]
    squared = (gap * gap).sum(axis=2)
    tracks, candidates = np.nonzero(squared <= max_dist * max_dist)
    free = np.ones(len(points), bool)
    for k in np.argsort(squared[tracks, candidates], kind="stable"):
        t, b = tracks[k], candidates[k]
        if free[t] and track_of[b] < 0:
            track_of[b], free[t] = t, False
    return track_of


def walk(tracks: Tracks, frames: np.ndarray, points: np.ndarray, start: int | None, stop: int | None,
         max_dist: float, max_lost: int) -> Iterator[tuple[int, Tracks]]:
    """Advances `tracks` over boxes sorted by frame, and over the empty frames between them.

    `start` is the last frame already done. Stretches in which no track is
    active are skipped. With `stop` the walk goes on to that frame.
    """
    numbers, first = np.unique(frames, return_index=True)
    nothing = np.empty((0, 2), np.int64)
    done = start
    for number, boxes in zip(numbers.tolist(), np.split(points, first[1:])):
        while done is not None and done + 1 < number and len(tracks.ids):
            done += 1
            tracks.advance(nothing, max_dist, max_lost)
            yield done, tracks
        tracks.advance(boxes, max_dist, max_lost)
        done = number
        yield done, tracks
    while stop is not None and done is not None and done < stop and len(tracks.ids):
        done += 1
        tracks.advance(nothing, max_dist, max_lost)
        yield done, tracks


def rows_of(steps: Iterator[tuple[int, Tracks]]) -> pd.DataFrame:
    """Track rows of the given frames; a track without a box of its own is coasting."""
    frames, ids, points, coasting = [], [], [], []
    for number, tracks in steps:
        frames.append(np.full(len(tracks.ids), number, np.int64))
        ids.append(tracks.ids)
        points.append(tracks.points.copy())
        coasting.append(tracks.lost > 0)
    if not frames:
        return pd.DataFrame({"track_id": pd.Series(dtype="int64"), "frame_id": pd.Series(dtype="int64"),
                             "cx": pd.Series(dtype="int32"), "cy": pd.Series(dtype="int32"),
                             "coasting": pd.Series(dtype="bool")})
    xy = np.concatenate(points).astype(np.int32)
    return pd.DataFrame({"track_id": np.concatenate(ids), "frame_id": np.concatenate(frames),
                         "cx": xy[:, 0], "cy": xy[:, 1], "coasting": np.concatenate(coasting)})


@dataclass(frozen=True)
class _Walk:
    """Walks one block of frames."""

    size: int
    max_dist: float
    max_lost: int

    def guessed(self, key: tuple, boxes: pa.Table) -> pa.Table:
        """From the frames before the block that are among its rows; nothing comes from a block without rows of its own."""
        boxes, block = _sorted(boxes), key[2].as_py()
        frames, points = _arrays(boxes)
        own = int(np.searchsorted(frames, block * self.size))
        tracks = Tracks()
        for _ in walk(tracks, frames[:own], points[:own], None, block * self.size - 1, self.max_dist, self.max_lost):
            pass
        return self._block(key, tracks, frames[own:], points[own:], 0)

    def corrected(self, key: tuple, boxes: pa.Table, starts: pa.Table) -> pa.Table:
        """From the tracks that the block before ends with."""
        frames, points = _arrays(_sorted(boxes))
        state = pd.DataFrame(starts["state"][0].as_py(), columns=["cx", "cy", "lost"]).astype("int64")
        tracks = Tracks(points=state[["cx", "cy"]].to_numpy(), lost=state["lost"].to_numpy().copy(), ids=np.arange(len(state)))
        return self._block(key, tracks, frames, points, starts["round"][0].as_py())

    def _block(self, key: tuple, tracks: Tracks, frames: np.ndarray, points: np.ndarray, round_: int) -> pa.Table:
        block, begin = key[2].as_py(), _state(tracks)
        if not len(frames):
            return pa.table({name: pa.array([], kind) for name, kind in self.types.items()})
        known = len(tracks.ids)
        tracks.ids, tracks.next_id = np.arange(known, dtype=np.int64), known
        rows = rows_of(walk(tracks, frames, points, block * self.size - 1, (block + 1) * self.size - 1, self.max_dist, self.max_lost))
        places = pa.StructArray.from_arrays([pa.array(rows[c].to_numpy()) for c in ("track_id", "frame_id", "cx", "cy", "coasting")],
                                            names=["track", "frame_id", "cx", "cy", "coasting"])
        one = [*(k.as_py() for k in key), round_, int(frames[-1]), begin, _state(tracks), tracks.ids.tolist(), tracks.next_id - known]
        columns = {name: pa.array([v], kind) for (name, kind), v in zip(self.types.items(), one)}
        return pa.table({**columns, "places": pa.ListArray.from_arrays(pa.array([0, len(places)], pa.int32()), places)})

    @property
    def types(self) -> dict[str, pa.DataType]:
        text, long = pa.string(), pa.int64()
        return {"camera_name": text, "side": text, BLOCK: long, "round": pa.int32(), "last_box": long, "begin": _STATE, "end": _STATE,
                "own": pa.list_(long), "fresh": long, "places": _PLACES}


def _sorted(boxes: pa.Table) -> pa.Table:
    return boxes.sort_by([("frame_id", "ascending"), ("box_id", "ascending")])


def _arrays(boxes: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return boxes["frame_id"].to_numpy(), np.stack([boxes["cx"].to_numpy(), boxes["cy"].to_numpy()], axis=1).astype(np.int64)


def _state(tracks: Tracks) -> list[dict[str, int]]:
    return [{"cx": x, "cy": y, "lost": n} for (x, y), n in zip(tracks.points.tolist(), tracks.lost.tolist())]


def walk_blocks(centred: DataFrame, how: _Walk, warm_up: int) -> DataFrame:
    """Every block with boxes, walked from its guess. A block also gets the boxes of the last `warm_up` frames before it."""
    block, size = block_of("frame_id", how.size), F.lit(how.size)
    late = F.pmod("frame_id", size) >= how.size - min(warm_up, how.size)
    rows = centred.select("*", F.explode(F.when(late, F.array(block, block + 1)).otherwise(F.array(block))).alias(BLOCK))
    # boxes are few bytes and much work: with a number of its own, partitions are not merged by their size
    parts = int(centred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *_KEYS).groupBy(*_KEYS).applyInArrow(lambda key, boxes: how.guessed(key, boxes), _WALKED)


def _agreed(centred: DataFrame, how: _Walk, warm_up: int) -> tuple[DataFrame, DataFrame]:
    """Walked blocks of all rounds, and which round of each block counts: (keys, round, last_box, begin, end, own, fresh).

    Each round walks the blocks again, in parallel, whose start is not the end of the block before. A block without a
    predecessor starts with no tracks: a whole block without boxes outlives all of them. So the first wrong block of a
    feed is right after each round, and mostly all are after one.
    """
    narrow = (*_KEYS, "round", "last_box", "begin", "end", "own", "fresh")
    walked = stored(walk_blocks(centred, how, warm_up), "walked")
    known = walked.select(*narrow)
    boxes = centred.withColumn(BLOCK, block_of("frame_id", how.size))
    round_ = 0
    while True:
        before = known.select(*FEED, (F.col(BLOCK) + 1).alias(BLOCK), F.col("end").alias("state"))
        wrong = known.join(before, list(_KEYS)).filter(F.col("begin") != F.col("state")).select(*_KEYS, "state")
        round_ += 1
        todo = stored(wrong.withColumn("round", F.lit(round_)), "seams")
        if todo.isEmpty():
            return walked, known
        again = boxes.join(todo.select(*_KEYS), list(_KEYS), "left_semi").groupBy(*_KEYS).cogroup(todo.groupBy(*_KEYS)).applyInArrow(
            lambda key, rows, starts: how.corrected(key, rows, starts), _WALKED)
        again = stored(again, "walked")
        walked = walked.unionByName(again)
        known = stored(known.join(again.select(*_KEYS), list(_KEYS), "left_anti").select(*narrow).unionByName(again.select(*narrow)), "blocks")


def _ids(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids over the seams: of the blocks (keys, first: the id of its first new track) and of the tracks that blocks end with
    (keys, place, track_id).

    A block's new tracks go on from those of all blocks before it. A track that a block has from the one before points
    to its place there; pointers are doubled until each leads to where its track is new.
    """
    counted = running_total(known.select(*_KEYS, "fresh"), F.col("fresh"), "_upto", BLOCK, FEED)
    first = stored(counted.select(*_KEYS, (F.col("_upto") - F.col("fresh")).alias("first")), "first-ids")
    ends = known.join(first, list(_KEYS)).select(*_KEYS, "first", F.size("begin").alias("_had"), F.posexplode("own").alias("place", "_own"))
    passed = F.col("_own") < F.col("_had")
    ends = ends.select(*_KEYS, "place", F.when(~passed, F.col("first") + F.col("_own") - F.col("_had")).alias("track_id"),
                       F.when(passed, F.col(BLOCK) - 1).alias("_at"), F.when(passed, F.col("_own")).alias("_there"))
    ends = stored(ends, "seam-tracks")
    while not ends.filter("track_id is null").isEmpty():
        up = ends.select(*FEED, F.col(BLOCK).alias("_at"), F.col("place").cast("long").alias("_there"), F.col("track_id").alias("_id"),
                         F.col("_at").alias("_next"), F.col("_there").alias("_next_there"))
        open_ = ends.filter("track_id is null").join(up, [*FEED, "_at", "_there"]).select(
            *_KEYS, "place", F.col("_id").alias("track_id"), F.col("_next").alias("_at"), F.col("_next_there").alias("_there"))
        ends = stored(ends.filter("track_id is not null").unionByName(open_), "seam-tracks")
    return first, ends.select(*_KEYS, "place", "track_id")


def assign_tracks(centred: DataFrame, max_dist: float = MAX_MATCH_PX, max_lost: int = MAX_LOST_FRAMES,
                  last_frame: int | None = None, block: int | None = None, warm_up: int | None = None) -> DataFrame:
    """Boxes with `cx`, `cy` and `side` to track positions; ids are unique within a camera and side.

    The same rows as one walk over each camera side in the order of its frames, for any `block` (frames that are walked
    by one task, more than `max_lost`) and any `warm_up` (frames before a block that its start is guessed from). Tracks coast
    up to the last frame of the feed that has boxes, or to `last_frame`. Boxes without camera, side or frame are left out.
    """
    how = _Walk(max(block or WALK_FRAMES, max_lost + 1), max_dist, max_lost)
    needed = centred.select(*FEED, "frame_id", "box_id", "cx", "cy").dropna(subset=[*FEED, "frame_id"])
    walked, known = _agreed(needed, how, WARM_UP_FRAMES if warm_up is None else warm_up)
    first, ends = _ids(known)
    had = ends.groupBy(*FEED, (F.col(BLOCK) + 1).alias(BLOCK)).agg(F.sort_array(F.collect_list(F.struct("place", "track_id"))).alias("_had"))
    last = known.groupBy(*FEED).agg(F.greatest(F.max("last_box"), F.lit(last_frame).cast("long")).alias("_last"))
    blocks = known.select(*_KEYS, "round").join(first, list(_KEYS)).join(had, list(_KEYS), "left").join(last, list(FEED))
    # an earlier track by its place, a new one by its number among the new ones
    earlier = F.coalesce(F.size("_had"), F.lit(0))
    named = F.when(F.col("_p.track") < earlier, F.get("_had", F.col("_p.track").cast("int"))["track_id"]).otherwise(
        F.col("first") + F.col("_p.track") - earlier)
    rows = walked.select(*_KEYS, "round", "places").join(blocks, [*_KEYS, "round"]).select(
        *FEED, "first", "_had", "_last", F.explode("places").alias("_p")).select(
        *FEED, named.alias("track_id"), "_p.frame_id", "_p.cx", "_p.cy", "_p.coasting", "_last")
    # tracks that outlive the last block with boxes before a gap
    alone = known.join(known.select(*FEED, (F.col(BLOCK) - 1).alias(BLOCK)), list(_KEYS), "left_anti")
    tails = alone.select(*_KEYS, F.posexplode("end").alias("place", "_t")).filter(F.col("_t.lost") < max_lost)
    tails = tails.join(ends, [*_KEYS, "place"]).join(last, list(FEED)).select(
        *FEED, "track_id", F.explode(F.sequence(F.lit(1), max_lost - F.col("_t.lost"))).alias("_k"), BLOCK, "_t", "_last").select(
        *FEED, "track_id", (F.col(BLOCK) * how.size + (how.size - 1) + F.col("_k")).alias("frame_id"), "_t.cx", "_t.cy", F.lit(True).alias("coasting"), "_last")
    return rows.unionByName(tails).filter(F.col("frame_id") <= F.col("_last")).drop("_last")
