"""Column functions for joint poses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def joint_rotation(axis: list[Column], angle: Column) -> Column:
    """Unit quaternion of a revolute joint turned by ``angle`` about a unit ``axis``."""
    half = angle.cast("double") / 2
    names = ["qx", "qy", "qz"]
    return F.struct(
        *[(a * F.sin(half)).alias(n) for a, n in zip(axis, names)], F.cos(half).alias("qw")
    )


POSE = ("x", "y", "z", "qx", "qy", "qz", "qw")


def parts(value: Column, names: tuple[str, ...] = POSE) -> list[Column]:
    """A struct's members. Sums of products are built from members, so that no struct is put together again and again."""
    return [value[n] for n in names]


def pose_struct(pose: list[Column]) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip(pose, POSE, strict=True)])


def no_motion() -> Column:
    return pose_struct([F.lit(0.0)] * 6 + [F.lit(1.0)])


def quaternion_product(a: list[Column], b: list[Column]) -> list[Column]:
    """The turn ``b`` followed by the turn ``a``; members in the order x, y, z, w."""
    (ax, ay, az, aw), (bx, by, bz, bw) = a, b
    return [aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx,
            aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz]


def rotate(q: list[Column], v: list[Column]) -> list[Column]:
    """A vector turned by a unit quaternion."""
    (qx, qy, qz, qw), (x, y, z) = q, v
    cx, cy, cz = 2 * (qy * z - qz * y), 2 * (qz * x - qx * z), 2 * (qx * y - qy * x)
    return [x + qw * cx + qy * cz - qz * cy, y + qw * cy + qz * cx - qx * cz, z + qw * cz + qx * cy - qy * cx]


def rpy_rotation(roll: Column, pitch: Column, yaw: Column) -> list[Column]:
    """Quaternion of turns about the fixed x, y and z axes, in this order."""
    zero = F.lit(0.0)
    about_x, about_y, about_z = ([F.sin(v / 2) if i == j else zero for j in range(3)] + [F.cos(v / 2)] for i, v in enumerate((roll, pitch, yaw)))
    return quaternion_product(about_z, quaternion_product(about_y, about_x))


def compose(a: Column, b: Column) -> Column:
    """The pose ``b`` given in the frame of the pose ``a``."""
    a, b = parts(a), parts(b)
    return pose_struct([p + m for p, m in zip(a[:3], rotate(a[3:], b[:3]), strict=True)] + quaternion_product(a[3:], b[3:]))


def unit_axis(axis: list[Column]) -> list[Column]:
    """The axis at length one; an axis of no length stays as it is."""
    length = F.sqrt(axis[0] * axis[0] + axis[1] * axis[1] + axis[2] * axis[2])
    return [F.coalesce(F.try_divide(a, length), F.lit(0.0)) for a in axis]


def joint_motion(kind: Column, axis: list[Column], value: Column) -> Column:
    """How a joint's child moves in the joint's frame: a turn about the unit axis (revolute, continuous), a shift
    along it (prismatic), nothing (fixed). A missing value is no motion."""
    turn = F.when(kind.isin("revolute", "continuous"), value).otherwise(F.lit(0.0)) / 2
    shift = F.when(kind == "prismatic", value).otherwise(F.lit(0.0))
    return pose_struct([a * shift for a in axis] + [a * F.sin(turn) for a in axis] + [F.cos(turn)])


def joint_transform_pose(origin: Column, kind: Column, axis: list[Column], value: Column) -> Column:
    """Child link in the parent link's frame: the joint's origin, then its motion."""
    motion = joint_motion(kind, axis, F.coalesce(value.cast("double"), F.lit(0.0)))
    # The lambda names the motion, so that it is worked out once.
    return F.get(F.transform(F.array(motion), lambda m: compose(origin, m)), F.lit(0))
