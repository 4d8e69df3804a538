"""Joint vectors: slices, long rows, overrides and poses."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from robolog.contracts import ARM_JOINTS
from robolog.functions.numeric import vector_slice
from robolog.functions.poses import POSE, compose, joint_rotation, joint_transform_pose, no_motion, pose_struct, rpy_rotation, unit_axis
from robolog.session import materialize


def joint_slices(
    df: DataFrame, vector: str, parts: Mapping[str, tuple[int, int]]
) -> DataFrame:
    """Add named slices of a vector; ``parts`` maps a name to (zero-based start, length)."""
    return df.select(
        "*", *[vector_slice(F.col(vector), s, n).alias(name) for name, (s, n) in parts.items()]
    )


def unpivot_joints(
    df: DataFrame, vector: str, keep: Sequence[str], joints: Sequence[str] = tuple(ARM_JOINTS)
) -> DataFrame:
    """One row per frame and joint; the joint order is the vector order."""
    names = F.array(*[F.lit(j) for j in joints])
    values = F.slice(F.col(vector), 1, len(joints))
    pairs = F.arrays_zip(names.alias("joint"), values.alias("angle"))
    return df.select(*keep, F.posexplode(pairs).alias("_pos", "_pair")).select(
        *keep,
        F.col("_pos").cast("bigint").alias("joint_no"),
        F.col("_pair")["joint"].alias("joint"),
        F.col("_pair")["angle"].alias("angle"),
    )


def parse_overrides(items: DataFrame, text: str = "item") -> DataFrame:
    """``NAME=VALUE`` rows as (joint, override, problem); later duplicates are the caller's."""
    position = F.instr(F.col(text), "=")
    name = F.trim(F.split_part(F.col(text), F.lit("="), F.lit(1)))
    raw = F.when(position > 0, F.expr(f"substring(`{text}`, instr(`{text}`, '=') + 1)"))
    value = F.trim(raw).try_cast("double")
    problem = (
        F.when(position == 0, "no value given")
        .when(name == "", "no joint given")
        .when(value.isNull(), "value is no number")
    )
    return items.select("*", name.alias("joint"), value.alias("override"), problem.alias("problem"))


def override_table(items: DataFrame, text: str = "item") -> dict[str, float]:
    """The overrides a table of ``NAME=VALUE`` rows gives; a row that is none is an error.

    The map is as small as the robot has joints: repeats are merged before it is collected, and
    of several values of a joint the largest counts.
    """
    parsed = parse_overrides(items, text)
    wrong = parsed.where("problem IS NOT NULL").select(text, "problem").limit(1).collect()
    if wrong:
        raise ValueError(f"override '{wrong[0][0]}': {wrong[0][1]}")
    return {r.joint: r.override for r in parsed.groupBy("joint").agg(F.max("override").alias("override")).collect()}


def override_map(items: Sequence[str]) -> dict[str, float]:
    """The overrides a caller gives, checked; the last one of a joint counts."""
    chosen: dict[str, float] = {}
    for item in items:
        name, found, raw = item.partition("=")
        if not found or not name.strip():
            raise ValueError(f"override '{item}' is not of the form NAME=VALUE")
        chosen[name.strip()] = float(raw)
    return chosen


def joint_overrides(
    rows: DataFrame,
    overrides: Mapping[str, float],
    joint: str = "joint",
    value: str = "angle",
    joints: Sequence[str] = tuple(ARM_JOINTS),
) -> DataFrame:
    """Replace the value of named joints. The overrides are a literal map, so no join.

    A name that is no joint of the robot is an error.
    """
    unknown = sorted(set(overrides) - set(joints))
    if unknown:
        raise ValueError(f"no such joint: {', '.join(unknown)}")
    if not overrides:
        return rows
    table = F.create_map(*[F.lit(x) for name, v in overrides.items() for x in (name, float(v))])
    replaced = F.coalesce(F.try_element_at(table, F.col(joint)), F.col(value).cast("double"))
    return rows.withColumn(value, replaced)


def joint_pose(
    rows: DataFrame,
    axes: Mapping[str, tuple[float, float, float]],
    joint: str = "joint",
    angle: str = "angle",
) -> DataFrame:
    """Add the rotation of each revolute joint about its axis as a quaternion."""
    def component(i: int):
        table = F.create_map(*[F.lit(x) for name, a in axes.items() for x in (name, float(a[i]))])
        return F.try_element_at(table, F.col(joint))

    pose = joint_rotation([component(0), component(1), component(2)], F.col(angle))
    return rows.withColumn("_pose", pose).select(
        *rows.columns, *[F.col("_pose")[q].alias(q) for q in ("qx", "qy", "qz", "qw")]
    )


#: What a table of joints has: names, kind, where it sits in the parent link (place and roll, pitch, yaw), axis,
#: and the position of its value in the joint vector (null: it has none).
JOINT_TABLE = (
    "joint string, parent string, child string, kind string, ox double, oy double, oz double, roll double, pitch double, yaw double, "
    "ax double, ay double, az double, slot int"
)
JOINT_KINDS = ("revolute", "continuous", "prismatic", "fixed")


def joint_origins(joints: DataFrame) -> DataFrame:
    """The joints with their origin as a pose and their motion's parameters as one struct; other kinds are an error."""
    known = F.when(F.col("kind").isin(*JOINT_KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("no such kind of joint: "), F.coalesce("kind", F.lit("none")))).cast("string"))
    given = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    origin = pose_struct([given(c, 0.0) for c in ("ox", "oy", "oz")] + rpy_rotation(*[given(c, 0.0) for c in ("roll", "pitch", "yaw")]))
    axis = unit_axis([given("ax", 1.0), given("ay", 0.0), given("az", 0.0)])
    named = [a.alias(c) for a, c in zip(axis, ("ax", "ay", "az"), strict=True)]
    # Worked out once per joint, not once per row that uses it.
    return materialize(joints.select("joint", "parent", "child", F.struct("joint", known.alias("kind"), "slot", *named, origin.alias("origin")).alias("spec")))


def _local(spec, vector) -> Column:
    value = F.when(spec["slot"].isNotNull(), F.get(vector, spec["slot"]))
    return joint_transform_pose(spec["origin"], spec["kind"], [spec["ax"], spec["ay"], spec["az"]], value)


def joint_transforms(rows: DataFrame, vector: str, keep: Sequence[str], joints: DataFrame) -> DataFrame:
    """One row per row and joint: the child link's pose in the parent link's frame.

    The joints, one robot's, come along as one value; rows are not moved.
    """
    specs = joint_origins(joints).agg(F.sort_array(F.collect_list(F.struct("joint", "parent", "child", "spec"))).alias("_specs"))
    posed = F.transform("_specs", lambda j: F.struct(j["joint"].alias("joint"), j["parent"].alias("parent"), j["child"].alias("child"), _local(j["spec"], F.col(vector)).alias("pose")))
    flat = rows.select(*keep, vector).crossJoin(F.broadcast(specs)).select(*keep, F.inline(posed))
    return flat.select(*keep, "joint", "parent", "child", *[F.col("pose")[n].alias(n) for n in POSE])


def link_chains(joints: DataFrame) -> DataFrame:
    """Every link with the joints from the root down to it: (link, chain). A ring of joints has no root and is an error."""
    session = joints.sparkSession
    specs = joint_origins(joints)
    view = f"joints_{uuid.uuid4().hex}"
    specs.createOrReplaceTempView(view)
    try:
        chains = session.sql(f"""
            WITH RECURSIVE chains (link, chain) AS (
              SELECT r.parent, slice(array(r.spec), 1, 0) FROM (SELECT parent, min(spec) AS spec FROM {view} GROUP BY parent) r LEFT ANTI JOIN {view} c ON c.child = r.parent
              UNION ALL
              SELECT j.child, concat(c.chain, array(j.spec)) FROM chains c JOIN {view} j ON j.parent = c.link)
            SELECT link, chain FROM chains""")
        chains.schema  # analysed while the view is there
    finally:
        session.catalog.dropTempView(view)
    return chains


def link_poses(rows: DataFrame, vector: str, keep: Sequence[str], joints: DataFrame) -> DataFrame:
    """One row per row and link: the link's pose in the frame of the root link.

    Only the tree of joints, which is as small as the robot, is walked by a recursive query. Each row then
    puts the joints of a chain together in one expression, so rows are neither moved nor joined per level.
    """
    every = link_chains(joints).agg(F.sort_array(F.collect_list(F.struct("link", "chain"))).alias("_chains"))
    from_root = F.transform("_chains", lambda c: F.struct(
        c["link"].alias("link"), F.size(c["chain"]).alias("depth"),
        F.aggregate(F.transform(c["chain"], lambda j: _local(j, F.col(vector))), no_motion(), compose).alias("pose")))
    flat = rows.select(*keep, vector).crossJoin(F.broadcast(every)).select(*keep, F.inline(from_root))
    return flat.select(*keep, "link", "depth", *[F.col("pose")[n].alias(n) for n in POSE])
