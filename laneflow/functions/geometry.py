"""Pixels, lines and the road plane."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from laneflow.config import CLASS_NAMES, OTHER_CLASS_NAME, TRUCK_MIN_AREA_PX, RoadPlane

KMH_PER_MS = 3.6


def box_middle(start: Column, size: Column) -> Column:
    """Middle of a box edge in whole pixels."""
    return (start + F.floor(size / 2)).cast("int")


def foot_point(x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column]:
    """Bottom centre of a box, where the vehicle meets the road."""
    return x + w / 2.0, (y + h).cast("double")


def size_class(w: Column, h: Column, truck_area: int = TRUCK_MIN_AREA_PX) -> Column:
    return F.when(w * h >= truck_area, "truck").otherwise("car")


def class_name(class_id: Column) -> Column:
    names = F.create_map(*[F.lit(v) for v in chain.from_iterable(CLASS_NAMES.items())])
    return F.coalesce(F.try_element_at(names, class_id), F.lit(OTHER_CLASS_NAME))


def crossed(prev: Column, cur: Column, line: Column, variant: str = "x") -> Column:
    """Whether a step from `prev` to `cur` crosses `line`; null `prev` never does.

    Variant x counts the line itself as the far side of the step, variant y as
    the near side, so the two differ for a vehicle that stops on the line.
    """
    if variant == "x":
        moved_over = (prev < line) != (cur < line)
    elif variant == "y":
        moved_over = (prev <= line) != (cur <= line)
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return F.coalesce(moved_over, F.lit(False))


def kmh(metres: Column, seconds: Column) -> Column:
    return metres / seconds * KMH_PER_MS


def euclidean(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    dx, dy = (x0 - x1).cast("double"), (y0 - y1).cast("double")
    return F.sqrt(dx * dx + dy * dy)


def project(plane: RoadPlane, x: Column, y: Column) -> tuple[Column, Column]:
    """A pixel on the road plane, in metres."""
    a, b, c, d, e, f, g, h, i = (F.lit(v) for v in plane.matrix)
    scale = g * x + h * y + i
    return (a * x + b * y + c) / scale, (d * x + e * y + f) / scale


def corrected_distance(plane: RoadPlane) -> Column:
    """Metres along the road between the projected middles of the two lines."""
    along = [project(plane, F.lit((left + right) / 2.0), F.lit(float(y)))[1]
             for left, right, y in (plane.line_1, plane.line_2)]
    return F.abs(along[1] - along[0])


def naive_distance(plane: RoadPlane) -> Column:
    """Metres between the lines if a pixel meant the same length everywhere."""
    (left_1, right_1, y_1), (left_2, right_2, y_2) = plane.line_1, plane.line_2
    mean_width = F.lit(((right_1 - left_1) + (right_2 - left_2)) / 2.0)
    return F.lit(float(y_2 - y_1)) * plane.line_length_m / mean_width


def effect_percent(corrected: Column, naive: Column) -> Column:
    """How much the perspective correction changes a figure, in percent."""
    return (corrected / naive - 1) * 100
