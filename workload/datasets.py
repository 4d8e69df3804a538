"""Published datasets: appending, versions, file packing, statistics that merge, payloads of unknown shape, joint trees."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from robolog.functions.poses import POSE
from robolog.functions.variants import flatten_variant
from robolog.operators.episodes import episode_stats, file_number
from robolog.operators.images import frame_packets
from robolog.operators.joints import JOINT_TABLE, joint_transforms, link_poses
from robolog.operators.packing import pack_files
from robolog.operators.stats import dataset_stats, feature_sketches, histogram_stats, image_histograms
from robolog.plans.dataset import append_dataset, build_dataset, publish
from robolog.session import scratch_path
from robolog.sinks.publish import read_dataset
from robolog.sinks.store import asof_in_store, read_store, write_store
from robolog.sinks.versions import version_sizes
from workload.log_time import asof_sql
from workload.registry import LOG, TOPICS, log, query, table
from workload.vectors import V, dataset_rows, robot

ACTION, STATE = ["effort", "position", "velocity"], ["eef_left", "eef_right", "grip_l", "grip_r"]
SETTINGS = {"action_dim": 42, "state_dim": 26, "task": "text", "file_mb": 0.01}
#: Segments from this name on come with the second batch.
SECOND = "seg-5"
EPISODES_SQL = """good AS (SELECT 'seg-' || bag_id AS segment_id, ts_ns, seq, 'task ' || (seq % 3) || ' of ' || (bag_id % 4) AS task
      FROM v WHERE bag_id <> 4 AND NOT (seq % 11 = 0))"""


def batches(spark, sf):
    rows = dataset_rows(spark, sf).withColumn("text", F.concat("text", F.lit(" of "), (F.col("bag_id") % 4).cast("string")))
    second = F.col("segment_id") >= SECOND
    return rows.where(~second), rows.where(second)


@query(
    "dataset_append",
    f"""{V}, {EPISODES_SQL},
      e AS (SELECT segment_id, count(*) AS length FROM good GROUP BY 1),
      x AS (SELECT *, row_number() OVER (ORDER BY segment_id) - 1 AS episode_index,
            CAST(coalesce(sum(length) OVER (ORDER BY segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_index FROM e),
      t AS (SELECT task, row_number() OVER (ORDER BY min((segment_id, ts_ns, seq))) - 1 AS task_index FROM good GROUP BY 1)
    SELECT segment_id, episode_index, row_number() OVER w - 1 AS frame_index, first_index + row_number() OVER w - 1 AS index, task, task_index,
      CAST(floor(first_index * 308 / (0.01::DOUBLE * 1048576)) AS BIGINT) AS file_index,
      (SELECT count(*) FROM e) AS total_episodes, (SELECT sum(length)::BIGINT FROM e) AS total_frames, (SELECT count(*) FROM t) AS total_tasks
    FROM good JOIN x USING (segment_id) JOIN t USING (task) WINDOW w AS (PARTITION BY segment_id ORDER BY ts_ns, seq)""",
)
def dataset_append(spark, sf):
    """Two batches published one after the other, read back: the rows of one run over both."""
    path = scratch_path(spark, "grown")
    first, second = batches(spark, sf)
    publish(build_dataset(first, ACTION, STATE, **SETTINGS), path)
    append_dataset(spark, path, second, ACTION, STATE, **SETTINGS)
    totals = read_dataset(spark, path, "info").select("total_episodes", "total_frames", "total_tasks")
    tasks = read_dataset(spark, path, "tasks").withColumnRenamed("task", "named")
    frames = read_dataset(spark, path).join(tasks, "task_index")
    return frames.select(
        "segment_id", "episode_index", "frame_index", "index", F.col("named").alias("task"), "task_index", file_number().alias("file_index")
    ).crossJoin(F.broadcast(totals))


@query(
    "published_versions",
    f"""{V}, {EPISODES_SQL}, n AS (SELECT segment_id >= '{SECOND}' AS late, count(*) AS frames, count(DISTINCT segment_id) AS episodes FROM good GROUP BY 1)
    SELECT 1 AS version, 1 AS n_batches, frames AS n_frames, episodes AS n_episodes FROM n WHERE NOT late
    UNION ALL SELECT 2, 2, sum(frames)::BIGINT, sum(episodes)::BIGINT FROM n
    UNION ALL SELECT 3, 1, frames, episodes FROM n WHERE late""",
)
def published_versions(spark, sf):
    """A dataset, more appended, a publication that fails while it writes, and one that replaces all: the versions readers have seen."""
    path = scratch_path(spark, "versions")
    first, second = batches(spark, sf)
    dataset = build_dataset(first, ACTION, STATE, **SETTINGS)
    publish(dataset, path)
    append_dataset(spark, path, second, ACTION, STATE, **SETTINGS)
    broken = F.when(F.col("frame_index") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("frame_index"))
    try:
        publish(type(dataset)(dataset.frames.withColumn("frame_index", broken.cast("bigint")), dataset.episodes, dataset.tasks, dataset.rejected, dataset.info), path, replace=True)
    except Exception as failed:  # noqa: BLE001  what it was is none of the readers' business
        if "lost" not in str(failed):
            raise
    publish(build_dataset(second, ACTION, STATE, **SETTINGS), path, replace=True)
    return version_sizes(spark, path)


PACK_BYTES = 4000


@query(
    "file_packing",
    f"""WITH RECURSIVE e AS (SELECT *, row_number() OVER (ORDER BY segment) AS n FROM (
        SELECT user_id || ':' || event_type AS segment, CAST(sum(octet_length(encode(props)) + 24) AS BIGINT) AS size_bytes FROM events GROUP BY 1)),
      walk AS (SELECT n, segment, size_bytes, size_bytes AS used, 0::BIGINT AS file FROM e WHERE n = 1
        UNION ALL SELECT e.n, e.segment, e.size_bytes, CASE WHEN used + e.size_bytes >= {PACK_BYTES} THEN e.size_bytes ELSE used + e.size_bytes END,
          CASE WHEN used + e.size_bytes >= {PACK_BYTES} THEN file + 1 ELSE file END FROM walk JOIN e ON e.n = walk.n + 1)
    SELECT segment, size_bytes, file // 10 AS chunk_index, file % 10 AS file_index FROM walk""",
)
def file_packing(spark, sf):
    """Measured payload sizes of a user's events of a kind, packed by next fit."""
    events = table(spark, sf, "events")
    sizes = events.groupBy(F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("segment")).agg(
        F.sum(F.octet_length("props") + 24).cast("bigint").alias("size_bytes"))
    return pack_files(sizes, target_bytes=PACK_BYTES, order="segment", files_per_chunk=10)


@query(
    "image_stats",
    """WITH b AS (SELECT page_id % 7 AS stream, CAST(i % 3 AS INTEGER) AS channel, CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS INTEGER) AS v
        FROM (SELECT page_id, hex(encode(html)) AS h, unnest(range(octet_length(encode(html)))) AS i FROM pages)),
      s AS (SELECT stream, channel, min(v) / 255.0::DOUBLE AS min, max(v) / 255.0::DOUBLE AS max, avg(v) / 255.0::DOUBLE AS mean,
          stddev_pop(v) / 255.0::DOUBLE AS std, count(*) AS count, quantile_disc(v, 0.5) / 255.0::DOUBLE AS q50, quantile_disc(v, 0.9) / 255.0::DOUBLE AS q90 FROM b GROUP BY 1, 2
        UNION ALL SELECT NULL, channel, min(v) / 255.0::DOUBLE, max(v) / 255.0::DOUBLE, avg(v) / 255.0::DOUBLE, stddev_pop(v) / 255.0::DOUBLE, count(*),
          quantile_disc(v, 0.5) / 255.0::DOUBLE, quantile_disc(v, 0.9) / 255.0::DOUBLE FROM b GROUP BY channel)
    SELECT stream, channel, round(min, 9) AS min, round(max, 9) AS max, round(mean, 9) AS mean, round(std, 9) AS std, count, round(q50, 9) AS q50, round(q90, 9) AS q90 FROM s""",
)
def image_stats(spark, sf):
    """Pages as raw frames of three interleaved channels, seven streams; without a stream: all of them, from the same histograms."""
    frames = table(spark, sf, "pages").select((F.col("page_id") % 7).alias("stream"), F.col("html").alias("data"))
    histograms = image_histograms(frames, ["stream"])
    every = histogram_stats(histograms, []).withColumn("stream", F.lit(None).cast("bigint"))
    stats = histogram_stats(histograms, ["stream"]).unionByName(every)
    return stats.select("stream", "channel", *[F.round(c, 9).alias(c) for c in ("min", "max", "mean", "std", "q50", "q90")], "count")


@query(
    "dataset_stats",
    f"""{V}, l AS (SELECT bag_id, 'action' AS feature, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim, unnest(embedding)::DOUBLE AS value FROM v
        UNION ALL SELECT bag_id, 'state', CAST(generate_subscripts(eef_left, 1) - 1 AS BIGINT), unnest(eef_left)::DOUBLE FROM v)
    SELECT feature, dim, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(*) AS count,
      count(DISTINCT bag_id) AS n_episodes, true AS ranks_hold FROM l GROUP BY 1, 2""",
)
def dataset_stats_query(spark, sf):
    """Statistics over all episodes merged from those of each; quantiles from merged sketches are held against the ranks they stand for."""
    rows = robot(spark, sf)
    features = {"action": "embedding", "state": "eef_left"}
    stats = dataset_stats(episode_stats(rows, features, episode="bag_id"), feature_sketches(rows, features, episode="bag_id"))
    long = rows.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(c).alias("x")) for f, c in features.items()]))).select("feature", F.posexplode("x").alias("dim", "value"))
    checks = {"q10": 0.1, "q50": 0.5, "q90": 0.9}
    joined = long.withColumn("dim", F.col("dim").cast("bigint")).join(stats, ["feature", "dim"])
    # The least rank of a quantile is the share below it, the greatest the share up to it.
    share = lambda c: F.count_if(c) / F.count(F.lit(1))
    value = F.col("value").cast("double")
    holds = [(share(value < F.col(q)) <= at + 0.05) & (share(value <= F.col(q)) >= at - 0.05) for q, at in checks.items()]
    ranks = joined.groupBy("feature", "dim").agg((holds[0] & holds[1] & holds[2]).alias("ranks_hold"))
    return stats.join(ranks, ["feature", "dim"]).select(
        "feature", "dim", "min", "max", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "count", "n_episodes", "ranks_hold")


def nested_payload() -> list:
    """Pieces of a JSON text that nests differently from row to row, members in no order of their names."""
    k, value, seq = (F.col(c).cast("string") for c in ("k", "value", "seq"))
    lists = F.concat(F.lit('{"z": ['), k, F.lit(", ["), value, F.lit(', null, [true, "a 7 b -2.5e1 [9"]]], "props": '), F.col("props"), F.lit(', "b": {"q": {"w": '), seq, F.lit(', "c": []}}}'))
    data = F.concat(F.lit('{"skip": 5, "in": {"x": 1, "data": [{"data": '), k, F.lit('}, {"y": '), value, F.lit(', "a": ["'), seq, F.lit('"]}]}, "name": null}'))
    numbers = F.concat(F.lit("["), value, F.lit(", "), k, F.lit(", 1.5]"))
    return [lists, data, numbers, k, F.lit("no json {")]


@query(
    "flatten_variant",
    f"""{LOG}, texts AS (SELECT seq, CASE seq % 5
        WHEN 0 THEN '{{"z": [' || k || ', [' || value || ', null, [true, "a 7 b -2.5e1 [9"]]], "props": ' || props || ', "b": {{"q": {{"w": ' || seq || ', "c": []}}}}}}'
        WHEN 1 THEN '{{"skip": 5, "in": {{"x": 1, "data": [{{"data": ' || k || '}}, {{"y": ' || value || ', "a": ["' || seq || '"]}}]}}, "name": null}}'
        WHEN 2 THEN '[' || value || ', ' || k || ', 1.5]' WHEN 3 THEN k::VARCHAR ELSE 'no json {{' END AS text FROM log),
      walk AS (WITH RECURSIVE r AS (
        SELECT seq, [0::BIGINT] AS place, text::JSON AS node FROM texts WHERE json_valid(text)
        UNION ALL
        SELECT r.seq, list_append(r.place, c.id::BIGINT), c.value FROM r, json_each(r.node) c
        WHERE json_type(r.node) IN ('OBJECT', 'ARRAY') AND (json_type(r.node) = 'ARRAY' OR c.key = 'data' OR NOT json_contains(json_keys(r.node)::JSON, '"data"')))
        SELECT * FROM r),
      leaves AS (SELECT seq, place, CASE json_type(node) WHEN 'VARCHAR' THEN list_transform(regexp_extract_all(json_extract_string(node, '$'), '[-+]?\\d*\\.?\\d+(?:[eE][-+]?\\d+)?'), lambda t: t::DOUBLE)
        WHEN 'BOOLEAN' THEN [CASE WHEN node::VARCHAR = 'true' THEN 1 ELSE 0 END::DOUBLE] WHEN 'NULL' THEN [] ELSE [node::VARCHAR::DOUBLE] END AS n
        FROM walk WHERE json_type(node) NOT IN ('OBJECT', 'ARRAY'))
    SELECT t.seq, coalesce((SELECT flatten(list(n ORDER BY place)) FROM leaves l WHERE l.seq = t.seq), [])::DOUBLE[] AS numbers FROM texts t""",
)
def flatten_variant_query(spark, sf):
    """Payloads of five shapes, one of them no JSON at all, flattened without a schema."""
    choice = F.element_at(F.array(*nested_payload()), (F.col("seq") % 5 + 1).cast("int"))
    rows = log(spark, sf).select("seq", choice.alias("text"))
    return flatten_variant(rows, "text", "numbers").select("seq", "numbers")


#: A robot for the joint queries, as a table of joints: an arm that turns, slides, and carries two fixed tools.
ROBOT = [
    ("turn", "base", "tower", "revolute", 0.1, 0.0, 0.3, 0.0, 0.0, 0.5, 0.0, 0.0, 1.0, 0),
    ("lift", "tower", "carriage", "prismatic", 0.0, 0.2, 0.0, 0.3, 0.0, 0.0, 0.0, 0.0, 2.0, 1),
    ("elbow", "carriage", "arm", "continuous", 0.4, 0.0, 0.1, 0.0, -0.7, 0.2, 0.0, 3.0, 4.0, 2),
    ("mount", "arm", "camera", "fixed", 0.0, 0.05, 0.02, 1.0, 0.5, -0.25, 1.0, 0.0, 0.0, None),
    ("wrist", "arm", "hand", "revolute", 0.3, 0.0, 0.0, 0.0, 0.1, 0.0, 1.0, 0.0, 0.0, 3),
    ("grip", "hand", "finger", "prismatic", 0.0, 0.0, 0.1, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 4),
]


def _product(a: str, b: str) -> list[str]:
    """Quaternion product in SQL; operands are column prefixes."""
    return [f"({a}w*{b}x + {a}x*{b}w + {a}y*{b}z - {a}z*{b}y)", f"({a}w*{b}y - {a}x*{b}z + {a}y*{b}w + {a}z*{b}x)",
            f"({a}w*{b}z + {a}x*{b}y - {a}y*{b}x + {a}z*{b}w)", f"({a}w*{b}w - {a}x*{b}x - {a}y*{b}y - {a}z*{b}z)"]


def _turned(q: str, x: str, y: str, z: str) -> list[str]:
    """A vector turned by a quaternion in SQL, by its rotation matrix."""
    return [f"((1 - 2*({q}y*{q}y + {q}z*{q}z))*{x} + 2*({q}x*{q}y - {q}z*{q}w)*{y} + 2*({q}x*{q}z + {q}y*{q}w)*{z})",
            f"(2*({q}x*{q}y + {q}z*{q}w)*{x} + (1 - 2*({q}x*{q}x + {q}z*{q}z))*{y} + 2*({q}y*{q}z - {q}x*{q}w)*{z})",
            f"(2*({q}x*{q}z - {q}y*{q}w)*{x} + 2*({q}y*{q}z + {q}x*{q}w)*{y} + (1 - 2*({q}x*{q}x + {q}y*{q}y))*{z})"]


def _named(columns: list[str], names: str) -> str:
    return ", ".join(f"{c} AS {n}" for c, n in zip(columns, names.split(), strict=True))


_VALUES = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in ROBOT)
_M = ["cos(yaw/2)*cos(pitch/2)*sin(roll/2) - sin(yaw/2)*sin(pitch/2)*cos(roll/2)", "cos(yaw/2)*sin(pitch/2)*cos(roll/2) + sin(yaw/2)*cos(pitch/2)*sin(roll/2)",
      "sin(yaw/2)*cos(pitch/2)*cos(roll/2) - cos(yaw/2)*sin(pitch/2)*sin(roll/2)", "cos(yaw/2)*cos(pitch/2)*cos(roll/2) + sin(yaw/2)*sin(pitch/2)*sin(roll/2)"]
JOINTS_SQL = f"""{V},
  j AS (SELECT * FROM (VALUES {_VALUES}) t(joint, parent, child, kind, ox, oy, oz, roll, pitch, yaw, ax, ay, az, slot)),
  o AS (SELECT *, {_named(_M, "rx ry rz rw")}, sqrt(ax*ax + ay*ay + az*az) AS l FROM j),
  m AS (SELECT bag_id, ts_ns, o.*, CASE WHEN kind IN ('revolute', 'continuous') THEN coalesce(embedding[slot + 1], 0)::DOUBLE ELSE 0 END AS a,
        CASE WHEN kind = 'prismatic' THEN coalesce(embedding[slot + 1], 0)::DOUBLE ELSE 0 END AS d FROM v, o),
  n AS (SELECT *, ax/l*sin(a/2) AS mx, ay/l*sin(a/2) AS my, az/l*sin(a/2) AS mz, cos(a/2) AS mw, ax/l*d AS sx, ay/l*d AS sy, az/l*d AS sz FROM m),
  t AS (SELECT bag_id, ts_ns, joint, parent, child, {_named([f"o{c} + {v}" for c, v in zip("xyz", _turned("r", "sx", "sy", "sz"), strict=True)], "x y z")},
        {_named(_product("r", "m"), "qx qy qz qw")} FROM n)"""
_ROUNDED = ", ".join(f"round({c}, 6) + 0 AS {c}" for c in POSE)


def joint_robot(spark):
    return spark.createDataFrame(ROBOT, JOINT_TABLE)


def _rounded(df, *keep):
    return df.select(*keep, *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in POSE])


@query("joint_transform", f"{JOINTS_SQL} SELECT bag_id, ts_ns, joint, parent, child, {_ROUNDED} FROM t")
def joint_transform_query(spark, sf):
    """Every joint's transform at every row: turning, sliding and fixed joints with their origins."""
    keep = ["bag_id", "ts_ns"]
    return _rounded(joint_transforms(robot(spark, sf), "embedding", keep, joint_robot(spark)), *keep, "joint", "parent", "child")


@query(
    "link_pose",
    f"""WITH RECURSIVE {JOINTS_SQL.removeprefix('WITH ')},
      w AS (SELECT bag_id, ts_ns, 'base' AS link, 0 AS depth, 0::DOUBLE AS x, 0::DOUBLE AS y, 0::DOUBLE AS z, 0::DOUBLE AS qx, 0::DOUBLE AS qy, 0::DOUBLE AS qz, 1::DOUBLE AS qw FROM v
        UNION ALL SELECT w.bag_id, w.ts_ns, t.child, depth + 1, {_named([f"w.{c} + {v}" for c, v in zip("xyz", _turned("w.q", "t.x", "t.y", "t.z"), strict=True)], "x y z")},
          {_named(_product("w.q", "t.q"), "qx qy qz qw")} FROM w JOIN t ON t.parent = w.link AND t.bag_id = w.bag_id AND t.ts_ns = w.ts_ns)
    SELECT bag_id, ts_ns, link, depth, {_ROUNDED} FROM w""",
)
def link_pose_query(spark, sf):
    """Every link's pose at every row, along the tree of joints."""
    keep = ["bag_id", "ts_ns"]
    return _rounded(link_poses(robot(spark, sf), "embedding", keep, joint_robot(spark)), *keep, "link", "depth")


@query(
    "log_store_asof",
    f"""{LOG}, c AS ({asof_sql()}), s AS (SELECT bag_id, count(*) AS n_rows FROM log GROUP BY 1)
    SELECT c.bag_id, ts_ns, seq, {", ".join(TOPICS.values())}, n_rows FROM c JOIN s USING (bag_id)""",
)
def log_store_asof(spark, sf):
    """Latest values at each view and a count per recording, both from a stored log and without moving it."""
    name = f"log_{uuid.uuid4().hex}"
    write_store(log(spark, sf).select("bag_id", "entity_path", "ts_ns", "seq", "value"), name, scratch_path(spark, "store"), buckets=8)
    store = read_store(spark, name)
    rows = store.groupBy("bag_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return asof_in_store(store, "view", TOPICS).join(rows, "bag_id")


PACKETS_SQL = """p AS (SELECT bag_id AS stream, ts_ns, seq, k % 7 = 0 AS is_key FROM log WHERE entity_path <> 'view'),
  n AS (SELECT *, row_number() OVER w - 1 AS packet_no, CAST(sum(is_key::INT) OVER w AS BIGINT) AS group_no FROM p WINDOW w AS (PARTITION BY stream ORDER BY ts_ns, seq)),
  v AS (SELECT bag_id AS stream, ts_ns FROM log WHERE entity_path = 'view' AND k % 5 = 0),
  f AS (SELECT v.stream, coalesce((SELECT max(packet_no) FROM n WHERE n.stream = v.stream AND n.ts_ns <= v.ts_ns), 0) AS packet_no FROM v WHERE v.stream IN (SELECT stream FROM n)),
  g AS (SELECT f.stream, f.packet_no, n.group_no, count(*) AS shown FROM f JOIN n USING (stream, packet_no) GROUP BY ALL)"""


@query(
    "frame_packets",
    f"""{LOG}, {PACKETS_SQL}
    SELECT n.stream, n.ts_ns, n.seq, n.packet_no, n.group_no, coalesce((SELECT shown FROM g WHERE g.stream = n.stream AND g.packet_no = n.packet_no), 0) AS shown
    FROM n WHERE n.packet_no <= (SELECT max(g.packet_no) FROM g WHERE g.stream = n.stream AND g.group_no = n.group_no)""",
)
def frame_packets_query(spark, sf):
    """Messages as packets, some with the signature of a key picture; a fifth of the views are the frames wanted."""
    rows = log(spark, sf)
    unit = F.when(F.col("k") % 7 == 0, F.lit(b"\x00\x00\x01\x67sps\x00\x00\x01\x65")).otherwise(F.lit(b"\x00\x00\x00\x01\x41"))
    packets = rows.where("entity_path <> 'view'").select(
        F.col("bag_id").alias("stream"), "ts_ns", "seq", F.concat(unit, F.col("props").cast("binary")).alias("packet"))
    wanted = rows.where("entity_path = 'view' AND k % 5 = 0").select(F.col("bag_id").alias("stream"), "ts_ns")
    return frame_packets(wanted, packets)
