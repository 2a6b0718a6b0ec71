"""Frame-by-frame models of the track operators, for small inputs."""

from __future__ import annotations

from collections import defaultdict


def by_track(rows, keys, order):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    for key in groups:
        groups[key].sort(key=lambda r: r[order])
    return groups


def crossed_x(a, b, line):
    return min(a, b) < line <= max(a, b)


def crossed_y(a, b, line):
    return min(a, b) <= line < max(a, b)


def laps(track, position, line_1, line_2, crossed):
    """(first frame, second frame); None where not reached."""
    first = second = None
    for before, now in zip(track, track[1:]):
        if first is None:
            if crossed(before[position], now[position], line_1):
                first = now["frame_id"]
        elif second is None and crossed(before[position], now[position], line_2):
            second = now["frame_id"]
    return first, second


def displacement(track, i, px_per_m, fps=25.0):
    kept = track[max(0, i - 9):i + 1]
    if len(kept) < 8:
        return None
    speed = abs(kept[-1]["cx"] - kept[0]["cx"]) / (len(kept) - 1) / px_per_m * fps * 3.6
    return speed if 5.0 < speed < 200.0 else None


def movement(track, i):
    kept = track[max(0, i - 9):i + 1]
    shift = kept[-1]["cx"] - kept[0]["cx"]
    if len(kept) < 4 or abs(shift) <= 10:
        return "unknown"
    return "right" if shift > 0 else "left"


def resolved(track, line_1, line_2, dist_m, px_per_m, fps=25.0):
    first, second = laps(track, "cx", line_1, line_2, crossed_x)
    for i, row in enumerate(track):
        speed = displacement(track, i, px_per_m, fps)
        if row["frame_id"] == second:
            return (dist_m / ((second - first) / fps) * 3.6, "tripwire", first / fps, movement(track, i), second)
        if speed is not None:
            return (speed, "displacement", 0.0, movement(track, i), row["frame_id"])
    return None


def greedy_tracks(frames, max_dist=180, max_lost=12):
    """frames: {frame: [(x, y), ...]} with every frame listed. Rows (track, frame, x, y, coasting)."""
    active, next_id, out = {}, 0, []
    for frame in sorted(frames):
        boxes = frames[frame]
        pairs = sorted(
            (((tx - bx) ** 2 + (ty - by) ** 2) ** 0.5, t, b)
            for t, (tx, ty, _) in active.items() for b, (bx, by) in enumerate(boxes))
        took, given = {}, set()
        for d, t, b in pairs:
            if d <= max_dist and t not in took and b not in given:
                took[t] = b
                given.add(b)
        for t in list(active):
            x, y, lost = active[t]
            if t in took:
                active[t] = (*boxes[took[t]], 0)
            elif lost + 1 > max_lost:
                del active[t]
            else:
                active[t] = (x, y, lost + 1)
        for b, box in enumerate(boxes):
            if b not in given:
                active[next_id] = (*box, 0)
                next_id += 1
        out += [(t, frame, x, y, lost > 0) for t, (x, y, lost) in active.items()]
    return out
