"""Parameters of the engine.

Every operator takes its numbers as arguments; the defaults come from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Speed limits and alert level, km/h.
CAR_LIMIT_KMH = 90.0
TRUCK_LIMIT_KMH = 80.0
ALERT_KMH = 130.0

# Windows of the per-lane questions.
WINDOW_S = 300
WATERMARK = "5 minutes"

# Frames and boxes.
FPS = 25.0
MIN_AREA_PX = 1500
TRUCK_MIN_AREA_PX = 9000

# Track assignment.
MAX_LOST_FRAMES = 12
MAX_MATCH_PX = 180

# Displacement speed and movement.
HISTORY_ROWS = 10
HISTORY_MIN_ROWS = 8
MOVEMENT_MIN_ROWS = 4
MOVEMENT_PX = 10
SPEED_LOW_KMH = 5.0
SPEED_HIGH_KMH = 200.0

# Reports.
SNAPSHOT_FRAMES = 125
ZONE_MARGIN_PX = 30
# A stored sketch of vehicles has at most 2^SKETCH_BITS bytes; a span is an hour of five-minute windows.
SKETCH_BITS = 12
SPAN_WINDOWS = 12
# Longest gap of a feed whose frames still count as empty ones: an hour.
ZONE_GAP_FRAMES = 90_000
SEGMENT_S = 120
MAX_SEGMENTS = 3

# Topics.
STATS_TOPIC = "traffic-stats"
ALERTS_TOPIC = "traffic-alerts"

# Class ids that count as vehicles, and their names.
CLASS_NAMES = {2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
OTHER_CLASS_NAME = "vehicle"

# Log lines. The speed comes as text with one digit.
ALERT_LINE = "⚠  SPEED ALERT #%d  |  cam=%-15s  %s %s  |  %s km/h  |  lane: %s"
TRACKER_ALERT_LINE = "⚠  SPEED ALERT  |  cam=%-20s  %s %s  |  %s km/h  |  %s"
NO_SPEEDS = "—"

# Names and output modes of the streaming questions.
QUESTION_STREAMS = {
    "Q1_Vehicle_Speeds": "append",
    "Q2_Vehicle_Count_Per_Lane": "complete",
    "Q3_Speed_Violations": "complete",
    "Q5_Vehicles_Per_Lane_Per_5min": "append",
    "Q6_Avg_Speed_Per_Lane_Per_5min": "append",
}

# Stand-ins for fields missing from an alert message.
ALERT_DEFAULTS = {
    "vehicle_id": "UNKNOWN",
    "vehicle_type": "vehicle",
    "carriageway": "?",
    "segment": "?",
}


@dataclass(frozen=True)
class Camera:
    """Geometry, calibration and lane names of one camera."""

    camera_name: str
    split: int = 640
    l1: int = 580
    l2: int = 100
    r1: int = 700
    r2: int = 1180
    dist_m: float = 28.0
    px_per_m: float = 16.0
    left_label: str = "left_lane"
    right_label: str = "right_lane"


CAMERAS = (
    Camera("IC_Papagou", 640, 590, 80, 690, 1200, 28.0, 16.0, "to_Katechaki", "to_Mesogeia_Vrilissia"),
    Camera("Roupaki_Toll_Station", 640, 570, 60, 710, 1210, 30.0, 15.0, "to_Elefsina", "to_Athens_Airport"),
)


@dataclass(frozen=True)
class RoadPlane:
    """Perspective calibration of a camera that looks along the road.

    ``matrix`` maps a pixel to metres on the road, row by row. Two horizontal
    lines across the road, each of a known length, are the tripwires.
    """

    matrix: tuple[float, ...] = (
        -0.07278562259306805, -0.08446726572528884, 60.58279845956355,
        0.0, -0.8118100128369705, 239.48395378690634,
        0.0, -0.006033376123234916, 1.0,
    )
    line_1: tuple[int, int, int] = (340, 940, 400)    # left x, right x, y
    line_2: tuple[int, int, int] = (100, 1180, 560)
    line_length_m: float = 25.0


ROAD_PLANE = RoadPlane()
REPORT_SPEEDS = (
    "tripwire_speed_corrected_kmh", "tripwire_speed_naive_kmh",
    "bev_avg_speed_kmh", "bev_min_speed_kmh", "bev_max_speed_kmh",
)
# --- end of fixed values ----------------------------------------------------

# Tracks are worked in blocks of so many frames, so that no task holds all of a long one.
BLOCK_FRAMES = 65_536
# Frames that one task of the tracker walks, and frames before them that it guesses its start from.
WALK_FRAMES = 1_024
WARM_UP_FRAMES = 256

# Files of a stored table that one micro-batch of a stream takes.
FILES_PER_TRIGGER = 1_000


@dataclass(frozen=True)
class StreamSettings:
    """Where a streaming job reads, writes and keeps its progress."""

    checkpoint_base: str
    bootstrap: str = "localhost:9092"
    stats_topic: str = STATS_TOPIC
    alerts_topic: str = ALERTS_TOPIC
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = None
    sink: str = "console"
    trigger: dict = field(default_factory=dict)
