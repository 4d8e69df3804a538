"""Vectors, features and joints over the embeddings table.

A label is a recording and ``vec_id`` its clock; slices of the 64 numbers stand for the
sensor vectors of the robot contract.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from robolog.contracts import ARM_JOINTS, STATE_WIDTHS
from robolog.functions.numeric import (
    checked_vector,
    concat_vectors,
    pad_vector,
    to_vector,
    vector_slice,
)
from robolog.operators import joints, quality, vectors
from robolog.operators.episodes import episode_stats, file_number
from robolog.plans.align import aligned_joints
from robolog.plans.dataset import build_dataset, publish
from robolog.session import scratch_path
from robolog.sinks.publish import read_dataset
from workload.registry import query, table

PARTS = {
    "effort": (0, 14),
    "position": (14, 14),
    "velocity": (28, 14),
    "eef_left": (0, 7),
    "eef_right": (7, 7),
    "grip_l": (14, 5),
    "grip_r": (19, 5),
}
PARTS_SQL = ", ".join(f"embedding[{s + 1}:{s + n}] AS {name}" for name, (s, n) in PARTS.items())
V = f"""WITH v AS (SELECT label AS bag_id, vec_id AS ts_ns, vec_id AS seq, embedding, {PARTS_SQL} FROM embeddings)"""


def robot(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        F.col("label").alias("bag_id"), F.col("vec_id").alias("ts_ns"), F.col("vec_id").alias("seq"), "embedding"
    )
    return joints.joint_slices(rows, "embedding", PARTS)


def numbers(df, keys, vector):
    """A vector as rows (keys, pos, number)."""
    return df.select(*keys, F.posexplode(vector).alias("pos", "number")).select(
        *keys, F.col("pos").cast("bigint").alias("pos"), F.col("number").cast("double").alias("number")
    )


def numbers_sql(keys: str, vector: str, source: str = "v") -> str:
    return f"""SELECT {keys}, CAST(generate_subscripts({vector}, 1) - 1 AS BIGINT) AS pos, unnest({vector})::DOUBLE AS number FROM {source}"""


@query("pad_vector", f"{V}, p AS (SELECT seq, list_concat(grip_l, [0::FLOAT]) AS x FROM v) {numbers_sql('seq', 'x', 'p')}")
def pad_vector_query(spark, sf):
    return numbers(robot(spark, sf), ["seq"], pad_vector(F.col("grip_l"), 6))


@query(
    "to_vector",
    f"{V}, x AS (SELECT seq, list_concat(embedding, [bag_id::FLOAT]) AS x FROM v) {numbers_sql('seq', 'x', 'x')}",
)
def to_vector_query(spark, sf):
    """A nested one-element list and a scalar, both as vectors, one after the other."""
    rows = robot(spark, sf).withColumn("nested", F.array("embedding"))
    def vector(name):
        return to_vector(F.col(name), rows.schema[name].dataType)
    return numbers(rows, ["seq"], concat_vectors(vector("nested"), vector("bag_id")))


@query(
    "assemble_action",
    f"{V}, x AS (SELECT seq, list_concat(list_concat(effort, position), velocity) AS x FROM v) {numbers_sql('seq', 'x', 'x')}",
)
def assemble_action(spark, sf):
    parts = [F.col(c) for c in ("effort", "position", "velocity")]
    return numbers(robot(spark, sf), ["seq"], checked_vector(concat_vectors(*parts), 42, "action"))


@query(
    "assemble_state",
    f"""{V}, x AS (SELECT seq, list_concat(list_concat(eef_left, eef_right), list_concat(list_concat(grip_l, [0::FLOAT]), list_concat(grip_r, [0::FLOAT]))) AS x FROM v)
    {numbers_sql('seq', 'x', 'x')}""",
)
def assemble_state(spark, sf):
    parts = [F.col("eef_left"), F.col("eef_right"), pad_vector(F.col("grip_l"), 6), pad_vector(F.col("grip_r"), 6)]
    return numbers(robot(spark, sf), ["seq"], checked_vector(concat_vectors(*parts), 26, "state"))


@query(
    "joint_slices",
    f"""{V}, x AS (SELECT seq, 'left' AS part, position[1:7] AS x FROM v UNION ALL SELECT seq, 'right', position[8:14] FROM v)
    {numbers_sql('seq, part', 'x', 'x')}""",
)
def joint_slices(spark, sf):
    sliced = joints.joint_slices(robot(spark, sf), "position", {"left": (0, 7), "right": (7, 7)})
    both = sliced.select(
        "seq",
        F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("x")) for p in ("left", "right")])),
    )
    return numbers(both, ["seq", "part"], F.col("x"))


PATHS = {
    "/info/eef_left": "eef_left",
    "/info/eef_right": "eef_right",
    "/info/gripper_feedback_L": "grip_l",
    "/info/gripper_feedback_R": "grip_r",
}
LONG_SQL = """long AS (
  SELECT bag_id, ts_ns, seq, '/info/eef_left' AS entity_path, 'translations' AS component,
         CASE WHEN seq % 4 = 0 THEN [] ELSE eef_left[1:3] END AS "values" FROM v
  UNION ALL SELECT bag_id, ts_ns, seq, '/info/eef_left', 'quaternions', CASE WHEN seq % 3 = 0 THEN NULL ELSE eef_left[4:7 - (bag_id % 2)] END FROM v
  UNION ALL SELECT bag_id, ts_ns, seq, '/info/eef_right', 'scalars', embedding[8:14 + bag_id % 4] FROM v
  UNION ALL SELECT bag_id, ts_ns, seq, '/info/gripper_feedback_L', 'message', grip_l[1:2 + seq % 4] FROM v)"""


def long_rows(spark, sf):
    """Sensor vectors in long form, some empty, null, short or too wide."""
    rows = robot(spark, sf)
    def part(path, component, values):
        return F.struct(
            F.lit(path).alias("entity_path"), F.lit(component).alias("component"), values.alias("values")
        )
    none = F.array().cast("array<float>")
    return rows.select(
        "bag_id", "ts_ns", "seq",
        F.inline(F.array(
            part("/info/eef_left", "translations", F.when(F.col("seq") % 4 == 0, none).otherwise(vector_slice(F.col("eef_left"), 0, 3))),
            part("/info/eef_left", "quaternions", F.when(F.col("seq") % 3 != 0, F.slice("eef_left", F.lit(4), F.lit(4) - F.col("bag_id") % 2))),
            part("/info/eef_right", "scalars", F.slice("embedding", F.lit(8), F.lit(7) + F.col("bag_id") % 4)),
            part("/info/gripper_feedback_L", "message", F.slice("grip_l", F.lit(1), (F.lit(2) + F.col("seq") % 4).cast("int"))),
        )),
    )


GRIPPER = STATE_WIDTHS["gripper"]
TARGET_SQL = "(VALUES ('/info/eef_left', 7), ('/info/eef_right', 7), ('/info/gripper_feedback_L', 6), ('/info/gripper_feedback_R', 6)) t(entity_path, expected)"


@query(
    "vector_width",
    f"""{V}, {LONG_SQL}, w AS (SELECT bag_id, entity_path, greatest(max(coalesce(len("values"), 0)), 1) AS inferred FROM long GROUP BY 1, 2)
    SELECT bag_id, w.entity_path, inferred, CAST(greatest(inferred, expected) AS BIGINT) AS width FROM w JOIN {TARGET_SQL} ON w.entity_path = t.entity_path""",
)
def vector_width(spark, sf):
    return vectors.vector_width(long_rows(spark, sf), GRIPPER)


DIMS_SQL = """dims AS (SELECT bag_id, entity_path, component, coalesce(arg_min(len("values"), ts_ns) FILTER (len("values") > 0), 0) AS dim FROM long GROUP BY 1, 2, 3)"""


@query(
    "observed_dims",
    f"""{V}, {LONG_SQL}, {DIMS_SQL} SELECT bag_id, entity_path, CAST(sum(dim) AS BIGINT) AS dim FROM dims GROUP BY 1, 2""",
)
def observed_dims(spark, sf):
    return vectors.observed_dims(long_rows(spark, sf))


@query(
    "dim_mismatch",
    f"""{V}, {LONG_SQL}, {DIMS_SQL}, o AS (SELECT bag_id, entity_path, CAST(sum(dim) AS BIGINT) AS dim FROM dims GROUP BY 1, 2)
    , firsts AS (SELECT bag_id, entity_path, component, arg_min("values", ts_ns) FILTER (len("values") > 0) AS sample FROM long GROUP BY 1, 2, 3),
      s AS (SELECT bag_id, entity_path, arg_min(sample, component) FILTER (sample IS NOT NULL) AS sample FROM firsts GROUP BY 1, 2)
    SELECT b.bag_id, t.entity_path, CAST(expected AS BIGINT) AS expected, coalesce(dim, 0) AS observed,
      coalesce(len(sample), -1) AS sample_size, sample[1]::DOUBLE AS sample_first
    FROM (SELECT DISTINCT bag_id FROM long) b CROSS JOIN {TARGET_SQL} LEFT JOIN o ON o.bag_id = b.bag_id AND o.entity_path = t.entity_path
    LEFT JOIN s ON s.bag_id = b.bag_id AND s.entity_path = t.entity_path
    WHERE coalesce(dim, 0) <> expected""",
)
def dim_mismatch(spark, sf):
    found = vectors.dim_mismatch(long_rows(spark, sf), GRIPPER)
    return found.select(
        "bag_id", "entity_path", "expected", "observed",
        F.coalesce(F.size("sample"), F.lit(-1)).cast("bigint").alias("sample_size"),
        F.get("sample", F.lit(0)).cast("double").alias("sample_first"),
    )


@query(
    "infer_features",
    f"""{V}, n AS (SELECT bag_id, seq, effort, CASE WHEN seq % 5 <> 0 THEN position END AS position, velocity,
          eef_left, CASE WHEN bag_id <> 3 THEN grip_l END AS grip_l FROM v),
      a AS (SELECT bag_id, arg_min(len(effort) + len(position) + len(velocity), seq) FILTER (position IS NOT NULL) AS action,
          arg_min(len(eef_left) + len(grip_l), seq) FILTER (grip_l IS NOT NULL) AS state FROM n GROUP BY 1)
    SELECT bag_id, 'action' AS name, 'float32' AS dtype, CAST(action AS VARCHAR) AS shape, action = 42 AS usable FROM a
    UNION ALL SELECT bag_id, 'observation.state', 'float32', coalesce(CAST(state AS VARCHAR), ''), state IS NOT NULL FROM a
    UNION ALL SELECT bag_id, 'observation.images.left_eye', 'video', (480 + bag_id) || 'x640x3', true FROM a""",
)
def infer_features(spark, sf):
    rows = (
        robot(spark, sf)
        .withColumn("position", F.when(F.col("seq") % 5 != 0, F.col("position")))
        .withColumn("grip_l", F.when(F.col("bag_id") != 3, F.col("grip_l")))
        .withColumn("height", F.col("bag_id") + 480)
        .withColumn("width", F.lit(640))
        .withColumn("channels", F.lit(3))
    )
    features = vectors.infer_features(
        rows,
        {"action": ["effort", "position", "velocity"], "observation.state": ["eef_left", "grip_l"]},
        names={"action": [f"a{i}" for i in range(42)]},
        images={"observation.images.left_eye": ("height", "width", "channels")},
    )
    return features.select(
        "bag_id", "name", "dtype", F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), "usable"
    )


JOINTS_SQL = "[" + ", ".join(f"'{j}'" for j in ARM_JOINTS) + "]"
UNPIVOT_SQL = f"""u AS (SELECT bag_id, ts_ns, CAST(generate_subscripts(position, 1) - 1 AS BIGINT) AS joint_no,
    unnest({JOINTS_SQL}) AS joint, unnest(position)::DOUBLE AS angle FROM v)"""


def joint_rows(spark, sf):
    rows = joints.unpivot_joints(robot(spark, sf), "position", ["bag_id", "ts_ns"])
    return rows.withColumn("angle", F.col("angle").cast("double"))


@query("unpivot_joints", f"{V}, {UNPIVOT_SQL} SELECT * FROM u")
def unpivot_joints(spark, sf):
    return joint_rows(spark, sf)


@query(
    "joint_overrides",
    f"""{V}, {UNPIVOT_SQL} SELECT bag_id, ts_ns, joint_no, joint,
        CASE joint WHEN 'Joint2_L' THEN -0.5::DOUBLE WHEN 'Joint7_R' THEN 1.25::DOUBLE ELSE angle END AS angle FROM u""",
)
def joint_overrides(spark, sf):
    chosen = joints.override_map(["Joint2_L=0.1", " Joint7_R = 1.25", "Joint2_L=-0.5"])
    return joints.joint_overrides(joint_rows(spark, sf), chosen)


def joint_axes():
    """Shoulder, elbow and wrist turn about z, y and x in turn."""
    turns = [(0.0, 0.0, 1.0), (0.0, 1.0, 0.0), (1.0, 0.0, 0.0)]
    return {j: turns[i % 3] for i, j in enumerate(ARM_JOINTS)}


POSE_COLUMNS = """round(CASE WHEN joint_no % 3 = 2 THEN sin(angle / 2) ELSE 0 END, 6) AS qx, round(CASE WHEN joint_no % 3 = 1 THEN sin(angle / 2) ELSE 0 END, 6) AS qy,
  round(CASE WHEN joint_no % 3 = 0 THEN sin(angle / 2) ELSE 0 END, 6) AS qz, round(cos(angle / 2), 6) AS qw"""


def rounded_pose(df, *keep):
    return df.select(*keep, *[F.round(q, 6).alias(q) for q in ("qx", "qy", "qz", "qw")])


@query("joint_pose", f"{V}, {UNPIVOT_SQL} SELECT bag_id, ts_ns, joint, {POSE_COLUMNS} FROM u")
def joint_pose(spark, sf):
    return rounded_pose(joints.joint_pose(joint_rows(spark, sf), joint_axes()), "bag_id", "ts_ns", "joint")


@query(
    "missing_joints",
    f"""{V}, f AS (SELECT DISTINCT bag_id, 'Joint' || (1 + (seq * (bag_id + 1)) % 9) || CASE WHEN seq % 2 = 0 THEN '_L' ELSE '_R' END AS name FROM v),
      w AS (SELECT bag_id, unnest({JOINTS_SQL}) AS name FROM (SELECT DISTINCT bag_id FROM v))
    SELECT bag_id, name, 'missing' AS problem FROM (SELECT * FROM w EXCEPT SELECT * FROM f)
    UNION ALL SELECT bag_id, name, 'unknown' FROM (SELECT * FROM f EXCEPT SELECT * FROM w)""",
)
def missing_joints(spark, sf):
    number = ((F.col("seq") * (F.col("bag_id") + 1)) % 9 + 1).cast("string")
    side = F.when(F.col("seq") % 2 == 0, "_L").otherwise("_R")
    found = robot(spark, sf).select("bag_id", F.concat(F.lit("Joint"), number, side).alias("name"))
    return quality.name_differences(found, ARM_JOINTS)


@query(
    "aligned_joints",
    f"""{V}, c AS (SELECT * FROM v WHERE seq % 3 = 0), m AS (SELECT * FROM v WHERE seq % 3 <> 0),
      a AS (SELECT c.bag_id, c.ts_ns, coalesce(m.position, list_transform(range(14), lambda i: 0::FLOAT)) AS position
            FROM c ASOF LEFT JOIN m ON c.bag_id = m.bag_id AND c.ts_ns >= m.ts_ns),
      u AS (SELECT bag_id, ts_ns, CAST(generate_subscripts(position, 1) - 1 AS BIGINT) AS joint_no, unnest({JOINTS_SQL}) AS joint, unnest(position)::DOUBLE AS angle FROM a)
    SELECT bag_id, ts_ns, joint, angle, {POSE_COLUMNS} FROM u""",
)
def aligned_joints_query(spark, sf):
    """Every third row stands for a camera frame, the others for messages: all rows are used."""
    rows = robot(spark, sf)
    clock = rows.where("seq % 3 = 0").select("bag_id", "ts_ns", "seq")
    messages = rows.where("seq % 3 <> 0").withColumnRenamed("position", "values")
    posed = aligned_joints(clock, messages.select("bag_id", "ts_ns", "seq", "values"), joint_axes())
    return rounded_pose(
        posed.withColumn("angle", F.col("angle").cast("double")), "bag_id", "ts_ns", "joint", "angle"
    )


STATS_SQL = """SELECT bag_id, 'action' AS feature, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim, unnest(embedding)::DOUBLE AS value FROM v
  UNION ALL SELECT bag_id, 'state', CAST(generate_subscripts(eef_left, 1) - 1 AS BIGINT), unnest(eef_left)::DOUBLE FROM v"""


@query(
    "episode_stats",
    f"""{V}, l AS ({STATS_SQL}) SELECT bag_id, feature, dim, min(value) AS min, max(value) AS max,
        round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(*) AS count FROM l GROUP BY 1, 2, 3""",
)
def episode_stats_query(spark, sf):
    stats = episode_stats(robot(spark, sf), {"action": "embedding", "state": "eef_left"}, episode="bag_id")
    return stats.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


def dataset_rows(spark, sf):
    """Segments of vectors with a task; one segment is too narrow, and some rows lack a part."""
    short = F.when(F.col("bag_id") == 4, F.slice("position", 1, 13)).otherwise(F.col("position"))
    return (
        robot(spark, sf)
        .withColumn("segment_id", F.concat(F.lit("seg-"), F.col("bag_id").cast("string")))
        .withColumn("position", F.when(F.col("seq") % 11 != 0, short))
        .withColumn("grip_l", pad_vector(F.col("grip_l"), 6))
        .withColumn("grip_r", pad_vector(F.col("grip_r"), 6))
        .withColumn("text", F.concat(F.lit("task "), (F.col("seq") % 3).cast("string")))
    )


@query(
    "build_dataset",
    f"""{V}, good AS (SELECT * FROM v WHERE bag_id <> 4 AND NOT (seq % 11 = 0)),
      e AS (SELECT 'seg-' || bag_id AS segment_id, count(*) AS length, round(sum(position[1]::DOUBLE), 6) AS joint_sum,
            count(DISTINCT seq % 3) AS n_tasks, round(avg(eef_left[1]::DOUBLE), 6) AS state_mean FROM good GROUP BY 1),
      x AS (SELECT *, row_number() OVER (ORDER BY segment_id) - 1 AS episode_index,
            CAST(coalesce(sum(length) OVER (ORDER BY segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_index FROM e)
    SELECT *, CAST(floor(first_index * 308 / (0.01::DOUBLE * 1048576)) AS BIGINT) AS file_index,
      first_index + length - 1 AS last_index FROM x""",
)
def build_dataset_query(spark, sf):
    """Vectors to a published dataset, read back from its files."""
    dataset = build_dataset(
        dataset_rows(spark, sf), ["effort", "position", "velocity"], ["eef_left", "eef_right", "grip_l", "grip_r"],
        action_dim=42, state_dim=26, task="text", file_mb=0.01,
    )
    path = scratch_path(spark, "dataset")
    publish(dataset, path)
    frames = read_dataset(spark, path).groupBy("episode_index").agg(
        F.max("index").alias("last_index"),
        F.round(F.sum(F.get("action", F.lit(14)).cast("double")), 6).alias("joint_sum"),
    )
    tasks = read_dataset(spark, path, "episode_tasks").groupBy("episode_index").agg(
        F.count(F.lit(1)).alias("n_tasks")
    )
    stats = read_dataset(spark, path, "stats").where("feature = 'observation_state'").select(
        "episode_index", F.round(F.get("mean", F.lit(0)), 6).alias("state_mean")
    )
    table = read_dataset(spark, path, "episodes").select(
        "segment_id", "episode_index", "length", "first_index", file_number().alias("file_index")
    )
    return table.join(frames, "episode_index").join(tasks, "episode_index").join(stats, "episode_index")
