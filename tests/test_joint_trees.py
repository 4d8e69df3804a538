"""Joint transforms and link poses, worked by hand."""

import math

import pytest

from robolog.operators.joints import JOINT_TABLE, joint_transforms, link_chains, link_poses

HALF = math.pi / 2
# A planar arm of three links, each one long, that turns about z; a slide; a camera turned on its mount.
ARM = [
    ("j1", "base", "l1", "revolute", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0),
    ("j2", "l1", "l2", "revolute", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 5.0, 1),
    ("j3", "l2", "l3", "prismatic", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0, 0.0, 0.0, 2),
    ("j4", "l3", "cam", "fixed", 0.0, 0.0, 0.5, 0.0, 0.0, HALF, None, None, None, None),
]


def posed(spark, vector, joints=ARM):
    rows = spark.createDataFrame([(1, vector)], "ts_ns bigint, v array<float>")
    return {r.link: r for r in link_poses(rows, "v", ["ts_ns"], spark.createDataFrame(joints, JOINT_TABLE)).collect()}


def place(r):
    return pytest.approx((r.x, r.y, r.z), abs=1e-6)


def turn_about_z(r):
    return 2 * math.atan2(r.qz, r.qw)


def test_three_links_by_hand(spark):
    at = posed(spark, [HALF, -HALF, 0.25])
    assert (0, 0, 0) == place(at["base"]) and (0, 0, 0) == place(at["l1"])
    # j1 turns the first link up, j2 turns the second level again, j3 slides along it.
    assert (0, 1, 0) == place(at["l2"]) and turn_about_z(at["l2"]) == pytest.approx(0, abs=1e-6)
    assert (1.25, 1, 0) == place(at["l3"])
    assert (1.25, 1, 0.5) == place(at["cam"]) and turn_about_z(at["cam"]) == pytest.approx(HALF, abs=1e-6)
    assert [at[n].depth for n in ("base", "l1", "l2", "l3", "cam")] == [0, 1, 2, 3, 4]


def test_a_missing_vector_or_value_is_no_motion(spark):
    for vector in (None, [], [None, 0.0, 0.0]):
        at = posed(spark, vector)
        assert (2, 0, 0) == place(at["l3"]) and (2, 0, 0.5) == place(at["cam"])


def test_origin_turns_apply_in_fixed_axes(spark):
    joints = [("j", "base", "tip", "prismatic", 0.0, 0.0, 0.0, HALF, 0.0, HALF, 0.0, 1.0, 0.0, 0)]
    rows = spark.createDataFrame([(1, [3.0])], "ts_ns bigint, v array<double>")
    (r,) = joint_transforms(rows, "v", ["ts_ns"], spark.createDataFrame(joints, JOINT_TABLE)).collect()
    # Roll takes y to z, yaw leaves z: the slide along y goes up.
    assert (0, 0, 3) == place(r) and (r.joint, r.parent, r.child) == ("j", "base", "tip")
    assert r.qx ** 2 + r.qy ** 2 + r.qz ** 2 + r.qw ** 2 == pytest.approx(1)


def test_a_tree_with_two_branches_and_roots(spark):
    joints = ARM + [("k", "l1", "tool", "fixed", 0.0, 2.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, None), ("r", "other", "leaf", "fixed", 1.0, 1.0, 1.0, None, None, None, 1.0, 0.0, 0.0, None)]
    at = posed(spark, [HALF, 0.0, 0.0], joints)
    assert (-2, 0, 0) == place(at["tool"]) and (1, 1, 1) == place(at["leaf"]) and len(at) == 8
    chains = {r.link: [s.joint for s in r.chain] for r in link_chains(spark.createDataFrame(joints, JOINT_TABLE)).collect()}
    assert chains["cam"] == ["j1", "j2", "j3", "j4"] and chains["base"] == [] and chains["tool"] == ["j1", "k"]


def test_unknown_kinds_fail(spark):
    with pytest.raises(Exception, match="no such kind of joint: floating"):
        posed(spark, [1.0], [("j", "a", "b", "floating", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0)])
