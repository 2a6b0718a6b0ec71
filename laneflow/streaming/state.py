"""Keyed state for the jobs that Spark's own streaming operators cannot express.

Spark has no ordered window functions in a stream. A track's last positions and
its first line crossing are therefore kept as state, a few numbers per track.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from laneflow.config import (
    FPS, HISTORY_MIN_ROWS, HISTORY_ROWS, MAX_LOST_FRAMES, MAX_MATCH_PX, MOVEMENT_MIN_ROWS, MOVEMENT_PX,
    SPEED_HIGH_KMH, SPEED_LOW_KMH, TRUCK_MIN_AREA_PX,
)
from laneflow.functions.geometry import KMH_PER_MS
from laneflow.operators.tracker import Tracks, rows_of, walk

# Results don't depend on the clock: by default state is kept, on disk. With a number of milliseconds, a silent track gives up
# its history but still knows that its event is out, and a silent camera gives out the frame it holds and keeps its ids.
IDLE_MS = None


#: Frame of a row that ends the feed of its camera and side: later than any frame, so the frame that is held is done.
END_OF_FEED = 2 ** 63 - 1


def with_ends(boxes: DataFrame, ends: DataFrame | None) -> DataFrame:
    """boxes and, for each row of ends (camera_name, side), a row that ends that feed. What comes later still counts."""
    if ends is None:
        return boxes
    fixed = {"camera_name": F.col("camera_name"), "side": F.col("side"), "frame_id": F.lit(END_OF_FEED)}
    marks = [fixed.get(f.name, F.lit("" if f.dataType.simpleString() == "string" else 0)).cast(f.dataType).alias(f.name) for f in boxes.schema.fields]
    return boxes.unionByName(ends.select(*marks))


def _timeout(idle_ms: int | None) -> str:
    return GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout

_RESOLVED = ("camera_name string, side string, track_id long, vehicle_id string, vehicle_type string, "
             "speed_kmh double, direction string, movement string, speed_source string, timestamp_s double, "
             "frame_id long")
_TRACK_STATE = "history array<int>, first_frame long, last_frame long, done boolean"


def _steps_over(previous: np.ndarray, current: np.ndarray, line: int) -> np.ndarray:
    """Variant x of `laneflow.functions.geometry.crossed`."""
    return (previous < line) != (current < line)


def resolve_tracks(histories: list[list[int]], firsts: list[int | None], sizes: np.ndarray, frames: np.ndarray, xs: np.ndarray,
                   lines: tuple[int, int], px_per_m: np.ndarray | float, fps: float) -> tuple:
    """Further positions of some tracks, track after track and in order of frames, `sizes` of each one.

    The new histories and first crossings of the tracks; and, one for each track, the number of the row that gives its event
    (that of rows where none does), whether it has crossed both lines there, its speed by displacement, and its shift if it has
    enough rows to tell a way.
    """
    none = np.iinfo(np.int64).max
    sizes, xs = np.asarray(sizes, np.int64), xs.astype(np.int64)
    had = np.array([len(h) for h in histories], np.int64)
    head, track = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    # all positions that are known, those of the histories before the new ones
    place = np.arange(len(xs)) + np.cumsum(had)[track]
    known_xs = np.empty(len(xs) + int(had.sum()), np.int64)
    old = np.ones(len(known_xs), bool)
    old[place] = False
    known_xs[place], known_xs[old] = xs, np.concatenate([np.zeros(0, np.int64), *[np.asarray(h, np.int64) for h in histories if len(h)]])
    at = np.arange(len(xs)) - head[track] + had[track]
    moved = at > 0
    previous = known_xs[place - moved]
    over_1, over_2 = (moved & _steps_over(previous, xs, line) for line in lines)
    first = np.array([none if f is None else f for f in firsts], np.int64)
    first = np.where(first != none, first, np.minimum.reduceat(np.where(over_1, frames, none), head))
    laps = over_2 & (frames > first[track])

    # `history` holds all positions of a young track, so counting from its start is right
    n = np.minimum(at + 1, HISTORY_ROWS)
    shift = xs - known_xs[place + 1 - n]
    with np.errstate(divide="ignore", invalid="ignore"):
        speed = np.abs(shift) / (n - 1) / px_per_m * fps * KMH_PER_MS
    valid = (n >= HISTORY_MIN_ROWS) & (speed > SPEED_LOW_KMH) & (speed < SPEED_HIGH_KMH)
    row = np.minimum.reduceat(np.where(laps | valid, np.arange(len(xs)), len(xs)), head)
    some = np.minimum(row, len(xs) - 1)
    way = np.where((n[some] >= MOVEMENT_MIN_ROWS) & (np.abs(shift[some]) > MOVEMENT_PX), shift[some], 0)
    ends = np.cumsum(sizes + had)
    kept = [known_xs[max(end - own, end - HISTORY_ROWS + 1) : end].tolist() for end, own in zip(ends.tolist(), (sizes + had).tolist())]
    return kept, [None if f == none else f for f in first.tolist()], row, laps[some], speed[some], way


def _event(kind: str | None, first: int | None, frame: int, crossed: bool, speed: float, way: int, dist_m: float, direction: str, fps: float) -> tuple:
    """What an event tells, from the kind of the vehicle on."""
    kind, way = kind if isinstance(kind, str) else "unknown", "right" if way > 0 else "left" if way < 0 else "unknown"
    if crossed:
        return kind, dist_m / ((frame - first) / fps) * KMH_PER_MS, direction, way, "tripwire", first / fps, frame
    return kind, speed, direction, way, "displacement", 0.0, frame


def resolve_track(history: list[int], first_frame: int | None, rows: pd.DataFrame, fps: float) -> tuple:
    """New history, first crossing, and the resolved event of a track or None, after further positions."""
    frames = rows["frame_id"].to_numpy(np.int64)
    histories, firsts, at, crossed, speed, way = resolve_tracks(
        [history], [first_frame], np.array([len(rows)]), frames, rows["cx"].to_numpy(np.int64),
        tuple(rows[["first_line", "second_line"]].iloc[0]), rows["px_per_m"].to_numpy(float), fps)
    event = None
    if at[0] < len(rows):
        row = rows.iloc[at[0]]
        event = _event(row["vehicle_type"], firsts[0], int(frames[at[0]]), crossed[0], float(speed[0]), way[0], row["dist_m"], row["direction"], fps)
    return histories[0], firsts[0], event


def resolved_stream(calibrated: DataFrame, fps: float = FPS, idle_ms: int | None = IDLE_MS) -> DataFrame:
    """Calibrated positions as a stream to one event per track, as `resolved_events` does for a table.

    The state of a track is its last positions, its first crossing and whether
    its event is out. Rows at or before a track's last frame are ignored.
    """

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _, _, last_frame, done = state.get
            state.update(([], None, last_frame, done))
            return
        history, first_frame, last_frame, done = state.get if state.exists else ([], None, None, False)
        rows = pd.concat(list(batches)).sort_values("frame_id", kind="stable")
        if last_frame is not None:
            rows = rows[rows["frame_id"] > last_frame]
        event = None
        if len(rows):
            last_frame = int(rows["frame_id"].iloc[-1])
            if not done:
                history, first_frame, event = resolve_track(list(history), first_frame, rows, fps)
        state.update((history, first_frame, last_frame, done or event is not None))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        if event is not None:
            camera, side, track = key
            yield pd.DataFrame([(camera, side, track, f"{side}{track}", *event)],
                               columns=[f.split()[0] for f in _RESOLVED.split(", ")])

    columns = ["camera_name", "side", "track_id", "frame_id", "cx", "first_line", "second_line", "dist_m",
               "px_per_m", "direction", "vehicle_type"]
    return calibrated.select(*columns).groupBy("camera_name", "side", "track_id").applyInPandasWithState(
        advance, _RESOLVED, _TRACK_STATE, "append", _timeout(idle_ms))


ASSIGNED = "camera_name string, side string, track_id long, frame_id long, cx int, cy int, coasting boolean"
# Boxes that a keyed task of a stream walks at once: what it holds beside the numbers of a batch's boxes doesn't grow with the batch.
PIECE_BOXES = 8_192


class _Boxes:
    """The boxes of one key in one batch, as plain numbers in the order of frames and box_id; of a tie the earlier one comes first.

    A batch may hold hours of a feed. Its rows come in small frames; only their numbers are kept, 20 to 30 bytes a box.
    """

    def __init__(self, columns: list[str]):
        self.size, self.held = 0, {c: np.zeros(0, np.int32) for c in columns}

    def add(self, rows: pd.DataFrame) -> None:
        """Copies the numbers, into arrays that grow by half: a view would hold the whole frame."""
        size = self.size + len(rows)
        for c in self.held:
            new = rows[c].to_numpy()
            old = self.held[c] = self.held[c].astype(np.promote_types(self.held[c].dtype, new.dtype), copy=False)
            if size > len(old):
                old.resize(size + size // 2, refcheck=False)
            old[self.size : size] = new
        self.size = size

    def sort(self) -> None:
        order = np.lexsort((self.held["box_id"][: self.size], self.held["frame_id"][: self.size]))
        for c in self.held:
            self.held[c] = self.held[c][order]
        self.held["frame_id"] = self.held["frame_id"].astype(np.int64, copy=False)

    def __len__(self) -> int:
        return self.size

    def newest(self, whole_frames: bool) -> int:
        """The first frame that is not done."""
        last = int(self.held["frame_id"][-1])
        return min(last + 1, END_OF_FEED) if whole_frames else last

    def part(self, low: int, high: int) -> dict[str, np.ndarray]:
        return {c: v[low:high] for c, v in self.held.items()}

    def rest(self, newest: int) -> dict[str, np.ndarray]:
        """The boxes of the frame that is not done."""
        return self.part(len(self) if newest == END_OF_FEED else int(np.searchsorted(self.held["frame_id"], newest)), len(self))

    def pieces(self, newest: int) -> Iterator[dict[str, np.ndarray]]:
        """The boxes before the frame newest, some whole frames at a time."""
        frames = self.held["frame_id"]
        at, end = 0, int(np.searchsorted(frames, newest))
        while at < end:
            stop = int(np.searchsorted(frames, frames[min(at + PIECE_BOXES, end) - 1], side="right"))
            yield self.part(at, stop)
            at = stop


def _walked(tracks: Tracks, piece: dict[str, np.ndarray], done: int | None, max_dist: float, max_lost: int) -> pd.DataFrame:
    points = np.stack([piece["cx"], piece["cy"]], axis=1).astype(np.int64)
    return rows_of(walk(tracks, piece["frame_id"], points, done, None, max_dist, max_lost))


_TRACKER_STATE = ("next_id long, ids array<long>, xs array<long>, ys array<long>, lost array<long>, done long, "
                  "waiting_frame long, waiting_xs array<long>, waiting_ys array<long>")


def tracks_stream(centred: DataFrame, max_dist: float = MAX_MATCH_PX, max_lost: int = MAX_LOST_FRAMES,
                  idle_ms: int | None = IDLE_MS, whole_frames: bool = False, with_late: bool = False) -> DataFrame:
    """Boxes as a stream to track positions, each (camera, side) as one session.

    A frame is done when a later one or the end of the feed (`with_ends`) has arrived,
    so its boxes may come in two batches; with `whole_frames`, for feeds whose
    batches hold whole frames, it is done with its batch. Boxes of a frame already
    done get no track: `with_late` adds the column `late` and gives them out with it
    true and without a track. The state is the active tracks and the boxes of the
    last frame. Boxes of one frame are taken in the order of `box_id`.
    """

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracks, done, boxes = Tracks(), None, _Boxes(["frame_id", "box_id", "cx", "cy"])
        if state.exists:
            next_id, ids, xs, ys, lost, done, frame, waiting_xs, waiting_ys = state.get
            tracks = Tracks(next_id, _whole(ids), np.stack([_whole(xs), _whole(ys)], axis=1), _whole(lost))
            boxes.add(pd.DataFrame({"frame_id": np.full(len(waiting_xs), frame, np.int64), "box_id": np.arange(len(waiting_xs)) - len(waiting_xs),
                                    "cx": _whole(waiting_xs), "cy": _whole(waiting_ys)}))
        for rows in () if state.hasTimedOut else batches:
            late = rows[rows["frame_id"] <= done] if done is not None else rows[:0]
            if with_late and len(late):
                yield pd.DataFrame({"camera_name": key[0], "side": key[1], "track_id": pd.Series(pd.NA, late.index, "Int64"),
                                    "frame_id": late["frame_id"], "cx": late["cx"], "cy": late["cy"], "coasting": False, "late": True})
            boxes.add(rows[rows["frame_id"] > done] if len(late) else rows)
        boxes.sort()
        if not len(boxes):
            return
        # a camera that has fallen silent sends no more of its last frame
        newest = boxes.newest(state.hasTimedOut or whole_frames)
        for piece in boxes.pieces(newest):
            out = _walked(tracks, piece, done, max_dist, max_lost)
            done = int(piece["frame_id"][-1])
            out.insert(0, "side", key[1])
            out.insert(0, "camera_name", key[0])
            yield out.assign(late=False) if with_late else out
        rest = boxes.rest(newest)
        state.update((tracks.next_id, tracks.ids.tolist(), tracks.points[:, 0].tolist(),
                      tracks.points[:, 1].tolist(), tracks.lost.tolist(), done, newest,
                      rest["cx"].astype(int).tolist(), rest["cy"].astype(int).tolist()))
        if idle_ms is not None and len(rest["cx"]):
            state.setTimeoutDuration(idle_ms)

    columns = ["camera_name", "side", "frame_id", "box_id", "cx", "cy"]
    return centred.select(*columns).groupBy("camera_name", "side").applyInPandasWithState(
        advance, ASSIGNED + (", late boolean" if with_late else ""), _TRACKER_STATE, "append", _timeout(idle_ms))


_LIVE = _RESOLVED + ", late boolean, box_id long, cx long, cy long"
_LIVE_STATE = "tracker string, vehicles string, waiting string"


def live_stream(boxes: DataFrame, max_dist: float = MAX_MATCH_PX, max_lost: int = MAX_LOST_FRAMES, fps: float = FPS,
                truck_area: int = TRUCK_MIN_AREA_PX, whole_frames: bool = False) -> DataFrame:
    """Boxes as a stream to one event per vehicle, and late boxes: tracked, classed and resolved by one keyed operator.

    `boxes` are centred, with the lines and scale of their camera and side (`sources.cameras.positions_calibrated`). The
    same events as `plans.live.boxes_to_events` gives for a table. The state of a camera and side is what the tracker
    holds, and for each active track its last positions, first crossing, class, and whether its event is out. Frames
    are done as in `tracks_stream`; boxes of frames that are done come out with `late` true, their `frame_id`, `box_id`, `cx`
    and `cy`, and no event.
    """
    numbers = ["frame_id", "box_id", "cx", "cy", "w", "h"]
    scale = ["first_line", "second_line", "dist_m", "px_per_m", "direction"]
    columns = numbers + scale
    names = [f.split()[0] for f in _LIVE.split(", ")]

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracks, vehicles, done, boxes, scales = Tracks(), {}, None, _Boxes(numbers), []
        if state.exists:
            tracker, known, waiting = map(json.loads, state.get)
            tracks = Tracks(tracker["next"], _whole(tracker["ids"]), _whole(tracker["points"]).reshape(-1, 2), _whole(tracker["lost"]))
            done, vehicles = tracker["done"], {int(k): v for k, v in known.items()}
            if waiting:
                boxes.add(pd.DataFrame(waiting, columns=columns))
                scales.append(waiting[0][len(numbers):])
        for rows in batches:
            late = rows[rows["frame_id"] <= done] if done is not None else rows[:0]
            if len(late):
                yield pd.DataFrame([(*key, *(None,) * 8, r.frame_id, True, r.box_id, r.cx, r.cy) for r in late.itertuples()], columns=names).astype(
                    {"track_id": "Int64", "speed_kmh": float, "timestamp_s": float})
                rows = rows[rows["frame_id"] > done]
            boxes.add(rows)
            real = rows[rows["frame_id"] < END_OF_FEED]
            if len(real) and len(scales) < 2:   # one camera and side has one scale: that of the held boxes, and the new one
                scales.append(real[scale].iloc[0].tolist())
        boxes.sort()
        if not len(boxes):
            return
        newest = boxes.newest(whole_frames)
        for piece in boxes.pieces(newest):
            out = _walked(tracks, piece, done, max_dist, max_lost)
            done = int(piece["frame_id"][-1])
            vehicles, events = _resolved(vehicles, out, tracks.ids, piece, scales[0], truck_area, fps)
            if events:
                yield pd.DataFrame([(*key, track, f"{key[1]}{track}", *event, False, None, None, None) for track, event in events], columns=names).astype(
                    dict.fromkeys(("box_id", "cx", "cy"), "Int64"))
        rest = boxes.rest(newest)
        held = [[*row, *scales[-1]] for row in zip(*[rest[c].tolist() for c in numbers])]
        tracker = {"next": tracks.next_id, "ids": tracks.ids.tolist(), "points": tracks.points.tolist(), "lost": tracks.lost.tolist(), "done": done}
        state.update((json.dumps(tracker), json.dumps(vehicles), json.dumps(held, default=lambda x: x.item())))

    return boxes.select("camera_name", "side", *columns).groupBy("camera_name", "side").applyInPandasWithState(
        advance, _LIVE, _LIVE_STATE, "append", GroupStateTimeout.NoTimeout)


def _whole(values) -> np.ndarray:
    return np.asarray(values, np.int64)


def _resolved(vehicles: dict[int, tuple], out: pd.DataFrame, active: np.ndarray, boxes: dict[str, np.ndarray], scale: list, truck_area: int,
              fps: float) -> tuple[dict[int, tuple], list[tuple]]:
    """What is known of the active tracks after further rows of a walk, and the events (track, what it tells) among these rows.

    vehicles: by track, its last positions, first crossing, class, and whether its event is out.
    """
    first_line, second_line, dist_m, px_per_m, direction = scale
    sent = {track for track, known in vehicles.items() if known[3]}
    ids, frames, xs, ys = (out[c].to_numpy() for c in ("track_id", "frame_id", "cx", "cy"))
    order = np.argsort(ids, kind="stable")
    order = order[~np.isin(ids[order], list(sent))] if sent else order
    ids, frames, xs, ys = ids[order], frames[order], xs[order].astype(np.int64), ys[order].astype(np.int64)
    kept = {track: vehicles[track] for track in active.tolist() if track in sent}
    if not len(ids):
        return kept, []
    names, head, sizes = np.unique(ids, return_index=True, return_counts=True)
    before = [vehicles.get(track, ([], None, None, False)) for track in names.tolist()]
    histories, firsts, row, crossed, speed, way = resolve_tracks(
        [h for h, *_ in before], [f for _, f, *_ in before], sizes, frames, xs, (first_line, second_line), px_per_m, fps)
    has, events, stays = row < len(ids), [], set(active.tolist())
    # the class is asked for where an event is, and else at the last row
    kinds = _kinds(np.where(has, row, head + sizes - 1), head, frames, xs, ys, boxes, truck_area)
    for i, track in enumerate(names.tolist()):
        kind = kinds[i] or before[i][2]
        if has[i]:
            events.append((track, _event(kind, firsts[i], int(frames[row[i]]), crossed[i], float(speed[i]), way[i], dist_m, direction, fps)))
        if track in stays:
            kept[track] = ([], None, None, True) if has[i] else (histories[i], firsts[i], kind, False)
    return kept, events


def _kinds(rows: np.ndarray, head: np.ndarray, frames: np.ndarray, xs: np.ndarray, ys: np.ndarray, boxes: dict[str, np.ndarray],
           truck_area: int) -> list[str | None]:
    """The class of a track at one of its rows each: that of the nearest box, in the latest frame with boxes; None if that is not among its rows."""
    numbers, first, many = np.unique(boxes["frame_id"], return_index=True, return_counts=True)
    at = np.searchsorted(numbers, frames[rows], side="right") - 1
    seen = np.flatnonzero((at >= 0) & (numbers[np.maximum(at, 0)] >= frames[head]))
    kinds: list[str | None] = [None] * len(rows)
    if not len(seen):
        return kinds
    at = at[seen]
    then = rows[seen] - (frames[rows[seen]] - numbers[at])      # a track has a row in each frame
    n = many[at]
    begin = np.cumsum(n) - n
    box = np.arange(n.sum()) - np.repeat(begin - first[at], n)
    apart = np.abs(boxes["cx"][box] - np.repeat(xs[then], n)) + np.abs(boxes["cy"][box] - np.repeat(ys[then], n))
    nearest = np.minimum.reduceat(np.where(apart == np.repeat(np.minimum.reduceat(apart, begin), n), box, len(boxes["cx"])), begin)
    for i, truck in zip(seen.tolist(), (boxes["w"][nearest].astype(np.int64) * boxes["h"][nearest] >= truck_area).tolist()):
        kinds[i] = "truck" if truck else "car"
    return kinds
