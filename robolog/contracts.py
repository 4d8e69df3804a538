"""Table schemas, robot contracts and the fixed names they use."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Camera names, topic paths, column names, joint names, widths
# and rates. They identify data in recordings and must not be changed.
# ---------------------------------------------------------------------------

# Recording folders: my_bag-yy-MM-dd-HH-mm-ss.
BAG_PREFIX = "my_bag-"
STAMP_FORMAT = "yy-MM-dd-HH-mm-ss"

CAMERAS = ["left_eye", "right_eye", "left_wrist", "right_wrist"]

TIMELINES = ["message_log_time", "message_publish_time", "ros2_timestamp"]

JOINT_PATHS = ["/joint_states/effort", "/joint_states/position", "/joint_states/velocity"]
POSE_PATHS = ["/info/eef_left", "/info/eef_right"]
GRIPPER_PATHS = ["/info/gripper_feedback_L", "/info/gripper_feedback_R"]
HAND_PATHS = [
    "/hand_left/joint_states/effort",
    "/hand_left/joint_states/position",
    "/hand_right/joint_states/effort",
    "/hand_right/joint_states/position",
]
VIDEO_PREFIX = "/video_stream"
TEXT_PATH = "/language_instruction"
IMAGE_PATH = "/camera/camera/color/image_raw/compressed"

STATE_WIDTHS = {
    "gripper": {
        "/info/eef_left": 7,
        "/info/eef_right": 7,
        "/info/gripper_feedback_L": 6,
        "/info/gripper_feedback_R": 6,
    },
    "hand": {
        "/info/eef_left": 7,
        "/info/eef_right": 7,
        "/hand_left/joint_states/effort": 20,
        "/hand_left/joint_states/position": 20,
        "/hand_right/joint_states/effort": 20,
        "/hand_right/joint_states/position": 20,
    },
}

# Component suffixes tried for a path, best first.
POSE_COMPONENTS = [
    "InstancePoses3D:translations",
    "InstancePoses3D:quaternions",
    "Scalars:scalars",
]
# Numbers of a translation, the first component.
TRANSLATION = 3
GRIPPER_COMPONENTS = ["std_msgs.msg.Float32MultiArray:message", "Scalars:scalars"]
SCALAR_COMPONENTS = ["Scalars:scalars"]
FALLBACK_EXCLUDES = "Mcap"

IMAGE_COLUMN_HINTS = [
    ":EncodedImage:blob",
    ":CompressedImage:message",
    ":McapSchema:data",
    ":McapChannel:message",
]
CODEC_COLUMN_HINTS = [
    ":McapSchema:encoding",
    ":McapChannel:message_encoding",
    ":EncodedImage:encoding",
]

ARM_JOINTS = [
    "Joint1_L", "Joint2_L", "Joint3_L", "Joint4_L", "Joint5_L", "Joint6_L", "Joint7_L",
    "Joint1_R", "Joint2_R", "Joint3_R", "Joint4_R", "Joint5_R", "Joint6_R", "Joint7_R",
]

DEFAULT_TASK = "task"
DEFAULT_SOURCE_FPS = 30.0
DEFAULT_TARGET_FPS = 10.0
FPS_TOLERANCE = 0.05
NS = 1_000_000_000

# End of fixed values.


def state_paths(mode: str) -> list[str]:
    """Paths that make up ``observation.state`` for an end-effector mode."""
    return list(STATE_WIDTHS[mode])


def source_paths(mode: str) -> list[str]:
    """Every sensor path aligned to the camera clock for a mode."""
    return JOINT_PATHS + state_paths(mode)


def training_contents(mode: str, with_text: bool = True) -> list[str]:
    """Content selection for training rows; ``/**`` selects a subtree."""
    tail = [TEXT_PATH] if with_text else []
    return source_paths(mode) + [VIDEO_PREFIX + "/**"] + tail


def column_preferences(mode: str) -> dict[str, list[str]]:
    """Fully qualified columns to try for each source path, best first."""
    def components(path: str) -> list[str]:
        if path in POSE_PATHS:
            return POSE_COMPONENTS
        if path in GRIPPER_PATHS:
            return GRIPPER_COMPONENTS
        return SCALAR_COMPONENTS

    return {p: [f"{p}:{c}" for c in components(p)] for p in source_paths(mode)}


MESSAGES = T.StructType([
    T.StructField("bag_id", T.StringType()),
    T.StructField("entity_path", T.StringType()),
    T.StructField("component", T.StringType()),
    T.StructField("log_time_ns", T.LongType()),
    T.StructField("publish_time_ns", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("values", T.ArrayType(T.DoubleType())),
    T.StructField("json", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("blob", T.BinaryType()),
    T.StructField("ros_time_ns", T.LongType()),
])

FRAMES = T.StructType([
    T.StructField("bag_id", T.StringType()),
    T.StructField("camera", T.StringType()),
    T.StructField("frame_no", T.LongType()),
    T.StructField("pts", T.LongType()),
    T.StructField("tb_num", T.IntegerType()),
    T.StructField("tb_den", T.IntegerType()),
    T.StructField("codec", T.StringType()),
    T.StructField("sample", T.BinaryType()),
])


@dataclass(frozen=True)
class ExportSpec:
    """What to export: lists of fully qualified columns, cameras, a task column."""

    action: list[str]
    state: list[str]
    task: str | None = None
    cameras: dict[str, str] = field(default_factory=dict)
    task_default: str = DEFAULT_TASK
    task_override: str | None = None
    fps: int | None = None
