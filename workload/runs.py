"""The whole-recording job over the event log, to disk and back."""

from __future__ import annotations

from pyspark.sql import functions as F

from robolog.operators.align import asof_align
from robolog.plans.dataset import run_tables
from robolog.session import scratch_path
from robolog.sinks.publish import read_dataset
from robolog.sources.catalog import list_files
from workload.log_time import asof_sql
from workload.registry import LOG, log, query

POSE, JOINTS, GRIP, WORDS = "/info/eef_left", "/joint_states/position", "/info/gripper_feedback_L", "/language_instruction"
TOPICS = {JOINTS: "position", POSE: "eef_left", GRIP: "grip_l"}
WIDTHS = {POSE: 7, GRIP: 6}
ACTION_DIM, FILE_MB = 2, 0.01
ROW_BYTES = 36 + 4 * (ACTION_DIM + 13)


def recordings(spark, sf):
    """Tables of recordings, one fault for each remainder of the user number by seven.

    1: the right eye lacks the last frame; 2: no clock anchor; 3: no left-eye frames; 4: the joint
    topic has no value; 5: a pose of eight numbers; 6 where the number is even: no right-eye frames.
    """
    rows = log(spark, sf)
    bag = F.concat(F.lit("bag-"), F.col("bag_id").cast("string"))
    fault = F.col("bag_id") % 7
    first = rows.groupBy("bag_id").agg(F.min("ts_ns").alias("first_frame_epoch_ns"), F.max(F.when(F.col("entity_path") == "view", F.struct("ts_ns", "seq"))).alias("last_view"))
    anchors = first.where(fault != 2).select(bag.alias("bag_id"), "first_frame_epoch_ns")
    views = rows.where("entity_path = 'view'").join(first, "bag_id").select("*", F.explode(F.array(F.lit("left_eye"), F.lit("right_eye"))).alias("camera"))
    lost = (F.col("camera") == "right_eye") & (fault == 1) & (F.struct("ts_ns", "seq") == F.col("last_view"))
    blind = (F.col("camera") == "right_eye") & (fault == 6) & (F.col("bag_id") % 2 == 0)
    frames = views.where(~lost & ~blind & ~((F.col("camera") == "left_eye") & (fault == 3))).select(
        bag.alias("bag_id"), "camera", F.col("seq").alias("frame_no"),
        F.expr("(ts_ns - first_frame_epoch_ns) DIV 1000").alias("pts"), F.lit(1).alias("tb_num"), F.lit(1_000_000).alias("tb_den"),
    )
    # The anchor of recordings without one is only used to make their frames.
    even = F.col("seq") % 2 == 0
    value, k = F.col("value"), F.col("k").cast("double")
    turn = F.array(k, value, F.lit(0.0), F.lit(2.0))
    pose = F.when(even, F.array(value, k, F.lit(1.0))).when(fault == 5, F.concat(turn, F.array(F.lit(5.0)))).otherwise(turn)
    messages = rows.where("entity_path <> 'view'").select(
        bag.alias("bag_id"),
        F.expr(f"CASE entity_path WHEN 'click' THEN '{POSE}' WHEN 'error' THEN '{JOINTS}' WHEN 'purchase' THEN '{GRIP}' ELSE '{WORDS}' END").alias("entity_path"),
        F.when(F.col("entity_path") == "click", F.when(even, "InstancePoses3D:translations").otherwise("InstancePoses3D:quaternions"))
        .when(F.col("entity_path") == "error", "Scalars:scalars")
        .when(F.col("entity_path") == "purchase", "std_msgs.msg.Float32MultiArray:message").alias("component"),
        "ts_ns", "seq",
        F.when(F.col("entity_path") == "click", pose)
        .when((F.col("entity_path") == "error") & (fault != 4), F.array(value, k))
        .when(F.col("entity_path") == "purchase", F.array(value)).alias("values"),
        F.when(F.col("entity_path") == "signup", F.concat(F.lit("task "), (F.col("k") % 4).cast("string"))).alias("text"),
    )
    bags = rows.select(bag.alias("bag_id")).distinct()
    return bags, anchors, frames, messages


def run(spark, sf):
    path = scratch_path(spark, "run")
    malformed = recordings(spark, sf)[0].where("bag_id LIKE '%9'").select("bag_id", F.lit("malformed records").alias("reason"))
    run_tables(*recordings(spark, sf), path, topics=TOPICS, widths=WIDTHS, action_dim=ACTION_DIM, file_mb=FILE_MB,
               cameras=("left_eye", "right_eye"), known_faults=malformed)
    return path


PART_TOPICS = {"t": "t", "q": "q", "p": "p", "g": "g", "s": "s"}
RUN_SQL = f"""parts AS (SELECT bag_id, ts_ns, seq,
    CASE WHEN entity_path = 'click' THEN CASE WHEN seq % 2 = 0 THEN 't' ELSE 'q' END
      WHEN entity_path = 'error' THEN 'p' WHEN entity_path = 'purchase' THEN 'g' WHEN entity_path = 'signup' THEN 's' ELSE 'view' END AS entity_path,
    {{'v': CASE WHEN entity_path = 'click' THEN CASE WHEN seq % 2 = 0 THEN [value, k, 1] ELSE [k, value, 0, 2] END
        WHEN entity_path = 'error' THEN [value, k] ELSE [value] END::FLOAT[], 'x': 'task ' || (k % 4)}} AS payload FROM log
    WHERE NOT (entity_path = 'error' AND bag_id % 7 = 4)),
  a AS ({asof_sql(value='payload', topics=PART_TOPICS, source='parts')}),
  every AS (SELECT bag_id, count(*) FILTER (entity_path = 'view') AS views FROM log GROUP BY 1),
  found AS (SELECT bag_id, count(t) AS t, count(q) AS q, count(p) AS p, count(g) AS g FROM a GROUP BY 1),
  clocks AS (SELECT bag_id, list_filter([
      CASE WHEN bag_id % 7 = 2 THEN 'no clock anchor' END,
      CASE WHEN views = 0 OR bag_id % 7 = 3 THEN 'no left_eye frames' END,
      CASE WHEN views = 0 OR (bag_id % 7 = 6 AND bag_id % 2 = 0) OR (bag_id % 7 = 1 AND views = 1) THEN 'no right_eye frames' END,
      CASE WHEN bag_id % 7 = 1 AND views > 1 THEN 'cameras differ in length' END,
      CASE WHEN bag_id % 10 = 9 THEN 'malformed records' END], lambda r: r IS NOT NULL) AS reasons FROM every),
  status AS (SELECT c.bag_id, CASE WHEN len(c.reasons) > 0 THEN c.reasons ELSE list_filter([
      CASE WHEN p = 0 THEN 'no value: {JOINTS}' END, CASE WHEN t = 0 THEN 'no value: {POSE}' END, CASE WHEN g = 0 THEN 'no value: {GRIP}' END,
      CASE WHEN bag_id % 7 = 5 AND q > 0 THEN 'vector of another width: {POSE}' END], lambda r: r IS NOT NULL) END AS reasons
    FROM clocks c LEFT JOIN found USING (bag_id)),
  rows AS (SELECT a.*, 'bag-' || a.bag_id AS bag, coalesce(s.x, 'task') AS task FROM a JOIN status USING (bag_id) WHERE len(reasons) = 0),
  eps AS (SELECT bag, count(*) AS length, min(ts_ns) AS first_ns FROM rows GROUP BY 1),
  numbers AS (SELECT *, row_number() OVER (ORDER BY bag) - 1 AS episode_index,
    CAST(coalesce(sum(length) OVER (ORDER BY bag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_index FROM eps)"""


@query(
    "run_full",
    f"""{LOG}, {RUN_SQL}
    SELECT bag AS bag_id, episode_index, row_number() OVER w - 1 AS frame_index, first_index + row_number() OVER w - 1 AS index,
      CAST((ts_ns - first_ns) / 1000000000.0::DOUBLE AS FLOAT)::DOUBLE AS timestamp, task,
      coalesce(p.v[1], 0)::DOUBLE AS a0, coalesce(p.v[2], 0)::DOUBLE AS a1, """
    + ", ".join(f"coalesce(t.v[{i}], 0)::DOUBLE AS s{i - 1}" for i in (1, 2, 3)) + ", "
    + ", ".join(f"coalesce(q.v[{i}], 0)::DOUBLE AS s{i + 2}" for i in (1, 2, 3, 4))
    + """, coalesce(g.v[1], 0)::DOUBLE AS s7, 13 AS n_state, '' AS reasons
      FROM rows JOIN numbers USING (bag) WINDOW w AS (PARTITION BY bag ORDER BY ts_ns, seq)
    UNION ALL SELECT 'bag-' || bag_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, """
    + ", ".join(["NULL"] * 9) + ", array_to_string(list_sort(reasons), '; ') FROM status WHERE len(reasons) > 0",
)
def run_full(spark, sf):
    """Frames read back from the dataset, and a row for every recording that is not in it."""
    path = run(spark, sf)
    number = lambda c, i: F.get(c, F.lit(i)).cast("double")
    frames = read_dataset(spark, path).select(
        "bag_id", "episode_index", "frame_index", "index", F.col("timestamp").cast("double").alias("timestamp"), "task",
        *[number("action", i).alias(f"a{i}") for i in range(2)],
        *[number("observation_state", i).alias(f"s{i}") for i in range(8)],
        F.size("observation_state").alias("n_state"), F.lit("").alias("reasons"),
    )
    status = read_dataset(spark, path, "status").where("NOT ok").select(
        "bag_id", F.array_join(F.array_sort("reasons"), "; ").alias("reasons"))
    return frames.unionByName(status, allowMissingColumns=True)


@query(
    "published_files",
    f"""{LOG}, {RUN_SQL}, f AS (SELECT *, CAST(floor(first_index * {ROW_BYTES} / ({FILE_MB}::DOUBLE * 1048576)) AS BIGINT) AS file FROM numbers)
    SELECT bag AS bag_id, length, length AS n_rows, true AS found, true AS in_place, file // 1000 AS chunk_index, file % 1000 AS file_index FROM f""",
)
def published_files(spark, sf):
    """Recorded files of each episode, held against the files that are there."""
    path = run(spark, sf)
    there = list_files(spark, f"{path}/data", "*.parquet").select(
        F.concat(F.lit("data/"), F.substring_index("path", "/", -4)).alias("path"), F.lit(True).alias("there"))
    files = read_dataset(spark, path, "episode_files").join(there, "path", "left")
    episodes = read_dataset(spark, path, "episodes").withColumnRenamed("segment_id", "bag_id")
    place = F.concat(F.lit("/chunk_index="), F.col("chunk_index"), F.lit("/file_index="), F.col("file_index"), F.lit("/"))
    joined = files.join(episodes, "episode_index").withColumn("_in", F.col("path").contains(place))
    return joined.groupBy("bag_id", "length", "chunk_index", "file_index").agg(
        F.sum("n_rows").alias("n_rows"), F.min(F.coalesce("there", F.lit(False))).alias("found"), F.min("_in").alias("in_place"))


@query(
    "dataset_info",
    f"""{LOG}, {RUN_SQL}, t AS (SELECT count(*) AS e, coalesce(sum(length), 0)::BIGINT AS f FROM numbers), k AS (SELECT count(DISTINCT task) AS n FROM rows),
      i AS (SELECT 'total_episodes' AS name, e AS number FROM t UNION ALL SELECT 'total_frames', f FROM t UNION ALL SELECT 'total_tasks', n FROM k)
    SELECT * FROM i UNION ALL SELECT 'action', {ACTION_DIM} UNION ALL SELECT 'observation_state', 13 UNION ALL
    SELECT unnest(['timestamp', 'frame_index', 'episode_index', 'index', 'task_index']), 1""",
)
def dataset_info(spark, sf):
    """Totals and feature widths as published."""
    path = run(spark, sf)
    info = read_dataset(spark, path, "info")
    totals = info.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("number")) for c in ("total_episodes", "total_frames", "total_tasks")])))
    features = read_dataset(spark, path, "features").select("name", F.get("shape", F.lit(0)).cast("bigint").alias("number"))
    return totals.unionByName(features)


@query(
    "component_parts",
    f"""{LOG}, {RUN_SQL} SELECT bag_id, ts_ns, seq, t.v[1]::DOUBLE AS t0, q.v[1]::DOUBLE AS q0, s.x AS words FROM a""",
)
def component_parts(spark, sf):
    """Two components of one topic and a text, on the clock in one scan."""
    rows = log(spark, sf)
    clock = rows.where("entity_path = 'view'").select("bag_id", "ts_ns", "seq")
    even = F.col("seq") % 2 == 0
    parts = rows.select(
        "bag_id", "ts_ns", "seq",
        F.when(F.col("entity_path") == "click", F.when(even, "t").otherwise("q")).when(F.col("entity_path") == "signup", "s").alias("part"),
        F.when(even, F.col("value")).otherwise(F.col("k")).cast("float").cast("double").alias("number"),
        F.concat(F.lit("task "), (F.col("k") % 4).cast("string")).alias("text"),
    )
    return asof_align(clock, parts, {"t": "t0", "q": "q0", "s": "words"}, topic="part", value={"t": "number", "q": "number", "s": "text"})


@query(
    "observed_report",
    f"""{LOG}, {RUN_SQL} SELECT (SELECT count(*) FROM status WHERE len(reasons) = 0) AS n_ok, (SELECT count(*) FROM status WHERE len(reasons) > 0) AS n_failed,
      (SELECT coalesce(sum(length), 0)::BIGINT FROM numbers) AS n_frames, (SELECT count(*) FROM numbers) AS n_episodes""",
)
def observed_report(spark, sf):
    """Recordings, frames and episodes of a run, counted by the passes that wrote them."""
    return read_dataset(spark, run(spark, sf), "run_report")
