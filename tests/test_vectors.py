import pytest
from pyspark.sql import functions as F, types as T

from robolog.contracts import ARM_JOINTS, STATE_WIDTHS, source_paths
from robolog.functions import numeric as num
from robolog.operators import joints, vectors


def one(df, column):
    return df.select(column.alias("x")).first().x


@pytest.fixture
def row(spark):
    return spark.range(1)


def flat(spark, value, ddl):
    dtype = T.StructType.fromDDL(f"v {ddl}")
    df = spark.createDataFrame([(value,)], dtype)
    return df.select(num.flatten_numeric(F.col("v"), dtype["v"].dataType).alias("x")).first().x


def test_flatten_numeric(spark):
    assert flat(spark, None, "array<double>") == []
    assert flat(spark, [[1.0, None], None, [2.5]], "array<array<double>>") == [1.0, 2.5]
    assert flat(spark, ([1.0, 2.0], 9), "struct<data: array<double>, n: int>") == [1.0, 2.0]
    assert flat(spark, (3, [4.0], "x5 and -6e1"), "struct<a: int, b: array<double>, c: string>") == [3, 4, 5, -60]
    assert flat(spark, ((None, 7.0), 1), "struct<p: struct<x: double, y: double>, q: int>") == [7.0, 1.0]
    assert flat(spark, {"data": 1.0, "z": 2.0}, "map<string, double>") == [1.0]
    assert flat(spark, {"y": 1.0}, "map<string, double>") == [1.0]
    assert flat(spark, True, "boolean") == [1.0]
    assert flat(spark, b"12", "binary") == []
    assert flat(spark, "1.5, .5 -3 +4e-2 a7", "string") == [1.5, 0.5, -3.0, 0.04, 7.0]


def test_strict_flattening(spark):
    dtype = T.StructType.fromDDL("v array<string>")
    df = spark.createDataFrame([(["1", "b 2", None, "3e1"],)], dtype)
    assert df.select(num.flatten_lists(F.col("v"), dtype["v"].dataType).alias("x")).first().x == [1.0, 30.0]


def test_pad_and_cut(spark, row):
    v = F.array(*[F.lit(float(i)) for i in range(1, 6)])
    assert one(row, num.pad_vector(v, 6)) == [1, 2, 3, 4, 5, 0]
    assert one(row, num.pad_vector(v, 3)) == [1, 2, 3]
    assert one(row, num.pad_vector(F.lit(None).cast("array<double>"), 2)) == [0, 0]
    assert row.select(num.pad_vector(v, 6).alias("x")).schema["x"].dataType.simpleString() == "array<float>"


def test_to_vector(spark, row):
    nested = T.ArrayType(T.ArrayType(T.DoubleType()))
    assert one(row, num.to_vector(F.array(F.array(F.lit(1.0), F.lit(2.0))), nested)) == [1.0, 2.0]
    assert one(row, num.to_vector(F.lit(3), T.IntegerType())) == [3.0]
    assert one(row, num.to_vector(F.lit(None).cast("int"), T.IntegerType())) is None


def test_checked_vector(spark, row):
    v = F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>")
    assert one(row, num.checked_vector(v, 2, "action")) == [1.0, 2.0]
    with pytest.raises(Exception, match="action vector is 2 wide, not 3"):
        one(row, num.checked_vector(v, 3, "action"))
    with pytest.raises(Exception, match="no state vector"):
        one(row, num.checked_vector(F.lit(None).cast("array<float>"), 3, "state"))


def test_castable_types():
    assert num.float_castable(T.ArrayType(T.DoubleType())) and num.float_castable(T.LongType())
    assert not num.float_castable(T.ArrayType(T.StringType()))


def test_contract_sizes():
    assert sum(STATE_WIDTHS["gripper"].values()) == 26
    assert sum(STATE_WIDTHS["hand"].values()) == 94
    assert len(source_paths("gripper")) == 7 and len(source_paths("hand")) == 9
    assert len(ARM_JOINTS) == 14


LONG = "bag_id string, entity_path string, component string, ts_ns bigint, seq bigint, `values` array<double>"


def test_dim_mismatch_of_a_recording(spark):
    good = [("a", "/info/eef_left", "t", 1, 1, [0.0] * 3), ("a", "/info/eef_left", "q", 1, 1, [0.0] * 4)]
    wide = [("a", "/info/eef_right", "s", 1, 1, [0.0] * 8)]
    late = [("a", "/info/gripper_feedback_L", "s", 1, 1, []), ("a", "/info/gripper_feedback_L", "s", 2, 2, [0.0] * 6)]
    df = spark.createDataFrame(good + wide + late, LONG)
    out = vectors.dim_mismatch(df, STATE_WIDTHS["gripper"]).collect()
    assert {r.entity_path: (r.observed, r.expected) for r in out} == {
        "/info/eef_right": (8, 7),
        "/info/gripper_feedback_R": (0, 6),
    }


def test_hand_mode_passes(spark):
    rows = [("a", p, "s", 1, 1, [0.0] * n) for p, n in STATE_WIDTHS["hand"].items()]
    df = spark.createDataFrame(rows, LONG)
    assert vectors.dim_mismatch(df, STATE_WIDTHS["hand"]).isEmpty()


def test_width_rules(spark):
    df = spark.createDataFrame([("a", "/g", "s", 1, 1, [1.0] * 5), ("a", "/n", "s", 1, 1, None)], LONG)
    out = {r.entity_path: (r.inferred, r.width) for r in vectors.vector_width(df, {"/g": 6}).collect()}
    assert out == {"/g": (5, 6), "/n": (1, 1)}


def test_infer_features(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, None, [1.0]), ("a", 2, 2, [1.0, 2.0], [3.0]), ("a", 3, 3, [1.0], [3.0]), ("b", 1, 1, [1.0], None)],
        "bag_id string, ts_ns bigint, seq bigint, p array<double>, q array<double>",
    )
    features = vectors.infer_features(df, {"action": ["p", "q"]}, names={"action": ["x", "y", "z"]})
    found = {r.bag_id: (r["shape"], r.usable) for r in features.collect()}
    assert found == {"a": ([3], True), "b": ([None], False)}
    with pytest.raises(ValueError):
        vectors.infer_features(df.withColumn("p", F.lit("no")), {"action": ["p"]})
    agreed = vectors.agreed_features(features.where("usable")).first()
    assert agreed["shape"] == [3] and agreed.agreed


def test_joint_dim(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, None), ("a", 2, 2, [1.0, 2.0])], "bag_id string, ts_ns bigint, seq bigint, p array<double>"
    )
    assert vectors.joint_dim(df, ["p"], "n").first().n == 2


def test_overrides(spark):
    items = spark.createDataFrame([("Joint1_L=0.5",), ("x",), ("=3",), ("J= 1.5 ",), ("J=a=b",)], "item string")
    out = [(r.joint, r.override, r.problem) for r in joints.parse_overrides(items).collect()]
    assert out[0] == ("Joint1_L", 0.5, None)
    assert out[1][2] == "no value given"
    assert out[2][2] == "no joint given"
    assert out[3] == ("J", 1.5, None)
    assert out[4][2] == "value is no number"
    for bad in ("x", "=3", "J=a"):
        with pytest.raises(ValueError):
            joints.override_map([bad])


def test_half_turn(spark):
    rows = spark.createDataFrame([("j", 3.141592653589793)], "joint string, angle double")
    pose = joints.joint_pose(rows, {"j": (0.0, 1.0, 0.0)}).first()
    assert [round(x, 9) for x in (pose.qx, pose.qy, pose.qz, pose.qw)] == [0, 1, 0, 0]
