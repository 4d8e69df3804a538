"""Sources, selection and reports over the message log."""

from __future__ import annotations

from pyspark.sql import functions as F

from robolog.contracts import CAMERAS, ExportSpec
from robolog.functions.numeric import flatten_json
from robolog.functions.times import (
    bag_timestamp,
    frame_time,
    normalize_time,
    ntz_micros,
    parse_bag_timestamp,
)
from robolog.operators import quality, select
from robolog.operators.images import tile_geometry, video_shape
from robolog.functions.images import inner_bounds
from robolog.sinks.publish import write_by_bag
from robolog.session import scratch_path
from robolog.sources.catalog import bag_catalog, clock_anchor, earliest_bag, missing_files
from workload.registry import LOG, TOPICS, log, query, table

DAY_NS = 86_400_000_000_000


@query("scan_messages", f"{LOG} SELECT bag_id, entity_path, ts_ns, seq, value, k FROM log")
def scan_messages(spark, sf):
    return log(spark, sf).select("bag_id", "entity_path", "ts_ns", "seq", "value", "k")


CAMERA_OF = dict(zip(TOPICS, CAMERAS))
CAMERA_SQL = "CASE entity_path " + " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in CAMERA_OF.items()) + " END"


def camera_frames(spark, sf):
    frames = log(spark, sf).where(F.col("entity_path").isin(*CAMERA_OF))
    return frames.withColumn("camera", F.expr(CAMERA_SQL)).withColumn(
        "sample", F.encode("props", "UTF-8")
    )


@query(
    "scan_frames",
    f"""{LOG} SELECT bag_id, {CAMERA_SQL} AS camera, ts_ns, seq, 'h264' AS codec,
        octet_length(encode(props)) AS n_bytes FROM log WHERE entity_path <> 'view'""",
)
def scan_frames(spark, sf):
    return camera_frames(spark, sf).select(
        "bag_id", "camera", "ts_ns", "seq", F.lit("h264").alias("codec"),
        F.octet_length("sample").cast("bigint").alias("n_bytes"),
    )


FILES_SQL = """paths AS (
  SELECT '/store/my_bag-' || strftime(ts, '%y-%m-%d') || '-' || bag_id || '/' ||
         CASE entity_path WHEN 'click' THEN 'data/data_0.mcap' WHEN 'error' THEN 'video/cameras.mp4'
           WHEN 'purchase' THEN 'video/left_eye.mp4' WHEN 'signup' THEN 'video/right_eye.mp4'
           ELSE 'video/cameras_first_frame.yaml' END AS path,
         k AS length FROM log)"""


def recorded_files(spark, sf):
    """A file listing: one entry per event, in folders by user and day."""
    name = (
        F.when(F.col("entity_path") == "click", "data/data_0.mcap")
        .when(F.col("entity_path") == "error", "video/cameras.mp4")
        .when(F.col("entity_path") == "purchase", "video/left_eye.mp4")
        .when(F.col("entity_path") == "signup", "video/right_eye.mp4")
        .otherwise("video/cameras_first_frame.yaml")
    )
    folder = F.concat(
        F.lit("/store/my_bag-"), F.date_format("ts", "yy-MM-dd"), F.lit("-"), F.col("bag_id").cast("string")
    )
    return log(spark, sf).select(
        F.concat_ws("/", folder, name).alias("path"), F.col("k").alias("length")
    )


@query(
    "bag_catalog",
    f"""{LOG}, {FILES_SQL}
    SELECT split_part(path, '/', 3) AS bag_id, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS bytes,
           count(*) FILTER (path LIKE '%/video/cameras.mp4') AS n_tiled_videos,
           substr(split_part(path, '/', 3), 8) AS bag_ts
    FROM paths GROUP BY 1, 5""",
)
def bag_catalog_query(spark, sf):
    return bag_catalog(recorded_files(spark, sf))


@query(
    "missing_inputs",
    f"""{LOG}, {FILES_SQL},
    found AS (SELECT DISTINCT split_part(path, '/', 3) AS bag_id, split_part(path, '/', 4) || '/' || split_part(path, '/', 5) AS name FROM paths),
    wanted AS (SELECT bag_id, name FROM (SELECT DISTINCT bag_id FROM found),
      unnest(['data/data_0.mcap', 'video/cameras_first_frame.yaml', 'video/left_eye.mp4', 'video/right_eye.mp4',
              'video/left_wrist.mp4', 'video/right_wrist.mp4']) AS t(name))
    SELECT bag_id, name FROM wanted EXCEPT SELECT bag_id, name FROM found""",
)
def missing_inputs_query(spark, sf):
    return missing_files(recorded_files(spark, sf))


@query(
    "clock_anchor",
    f"""{LOG} SELECT bag_id, min(ts_ns) AS first_frame_epoch_ns FROM log GROUP BY bag_id""",
)
def clock_anchor_query(spark, sf):
    first = log(spark, sf).groupBy("bag_id").agg(F.min("ts_ns").alias("first"))
    text = F.concat(
        F.lit("camera: left_eye\nfirst_frame_time:\n  sec: 7\n  epoch_ns: "),
        F.col("first").cast("string"),
        F.lit("\n"),
    )
    return clock_anchor(first.select("bag_id", text.alias("text")), strict=True)


@query(
    "segment_table",
    f"""{LOG} SELECT bag_id, count(*) AS n_rows, CAST(sum(octet_length(encode(props))) AS BIGINT) AS size_bytes,
        min(ts_ns) AS first_ns, max(ts_ns) AS last_ns FROM log GROUP BY bag_id""",
)
def segment_table_query(spark, sf):
    return select.segment_table(log(spark, sf), payload="props")


TIMELINES_SQL = """clocks AS (
  SELECT bag_id,
         CASE WHEN bag_id % 7 <> 0 AND k % 3 = 0 THEN ts_ns END AS log_time_ns,
         CASE WHEN bag_id % 5 <> 0 AND k > 40 THEN ts_ns END AS publish_time_ns,
         CASE WHEN bag_id % 2 = 0 THEN ts_ns END AS ros_time_ns, seq AS tick FROM log)"""


TIMELINE_COLUMNS = {
    "message_log_time": "log_time_ns",
    "message_publish_time": "publish_time_ns",
    "ros2_timestamp": "ros_time_ns",
    "tick": "tick",
}


def timeline_clocks(spark, sf):
    return log(spark, sf).select(
        "bag_id",
        F.when((F.col("bag_id") % 7 != 0) & (F.col("k") % 3 == 0), F.col("ts_ns")).alias("log_time_ns"),
        F.when((F.col("bag_id") % 5 != 0) & (F.col("k") > 40), F.col("ts_ns")).alias("publish_time_ns"),
        F.when(F.col("bag_id") % 2 == 0, F.col("ts_ns")).alias("ros_time_ns"),
        F.col("seq").alias("tick"),
    )


def timelines(spark, sf):
    return select.available_timelines(timeline_clocks(spark, sf), TIMELINE_COLUMNS)


AVAILABLE_SQL = f"""{LOG}, {TIMELINES_SQL}, available AS (
  SELECT bag_id, 'message_log_time' AS timeline, 0 AS r FROM clocks WHERE log_time_ns IS NOT NULL
  UNION SELECT bag_id, 'message_publish_time', 1 FROM clocks WHERE publish_time_ns IS NOT NULL
  UNION SELECT bag_id, 'ros2_timestamp', 2 FROM clocks WHERE ros_time_ns IS NOT NULL
  UNION SELECT bag_id, 'tick', 3 FROM clocks WHERE tick IS NOT NULL)"""


@query("available_timelines", f"{AVAILABLE_SQL} SELECT bag_id, timeline FROM available")
def available_timelines_query(spark, sf):
    return timelines(spark, sf)


@query(
    "pick_timeline",
    f"{AVAILABLE_SQL} SELECT bag_id, arg_min(timeline, r) AS timeline FROM available GROUP BY bag_id",
)
def pick_timeline_query(spark, sf):
    return select.pick_timeline(timelines(spark, sf))


@query(
    "reindex_timeline",
    f"""{AVAILABLE_SQL}, p AS (SELECT bag_id, arg_min(timeline, r) AS timeline FROM available GROUP BY bag_id),
      x AS (SELECT c.bag_id, c.tick, p.timeline, CASE p.timeline WHEN 'message_log_time' THEN log_time_ns
        WHEN 'message_publish_time' THEN publish_time_ns WHEN 'ros2_timestamp' THEN ros_time_ns ELSE tick END AS ts_ns
        FROM clocks c JOIN p ON c.bag_id = p.bag_id)
    SELECT * FROM x WHERE ts_ns IS NOT NULL""",
)
def reindex_timeline_query(spark, sf):
    """Messages keyed by the timeline their recording prefers."""
    rows = select.reindex_timeline(timeline_clocks(spark, sf), TIMELINE_COLUMNS)
    return rows.select("bag_id", "tick", "timeline", "ts_ns")


HOUR_SQL = "ts_ns - ts_ns % 3600000000000"


@query(
    "wide_reader",
    f"""{LOG} SELECT bag_id, {HOUR_SQL} AS ts_ns, """
    + ", ".join(
        f"arg_max(value, seq) FILTER (entity_path = '{p}') AS \"{c}\"" for p, c in {**TOPICS, "view": "view"}.items()
    )
    + " FROM log GROUP BY 1, 2",
)
def wide_reader_query(spark, sf):
    hourly = log(spark, sf).withColumn("ts_ns", F.expr(HOUR_SQL))
    return select.wide_reader(hourly, {**TOPICS, "view": "view"})


@query("project_columns", f"{LOG} SELECT bag_id, ts_ns, value FROM log")
def project_columns(spark, sf):
    return log(spark, sf).select("bag_id", "ts_ns", "value")


@query(
    "filter_contents",
    f"""{LOG} SELECT bag_id, entity_path || '/frame' AS entity_path, seq FROM log
        WHERE entity_path IN ('view', 'purchase')""",
)
def filter_contents_query(spark, sf):
    nested = log(spark, sf).withColumn("entity_path", F.concat("entity_path", F.lit("/frame")))
    chosen = select.filter_contents(nested, ["view/**", "purchase/frame", "/sign"])
    return chosen.select("bag_id", "entity_path", "seq")


@query("filter_segments", f"{LOG} SELECT bag_id, seq, value FROM log WHERE bag_id IN (3, 1, 4, 15, 92)")
def filter_segments_query(spark, sf):
    return select.filter_segments(log(spark, sf), [3, 1, 4, 15, 92]).select("bag_id", "seq", "value")


SPEC = ExportSpec(
    action=["error:Scalars:scalars", "click:Scalars:scalars"],
    state=["click:Scalars:scalars", "signup:Scalars:scalars"],
    task="purchase:TextDocument:text",
    cameras={"front": "view"},
)


@query(
    "spec_paths",
    f"""{LOG}, spec(entity_path, position) AS (VALUES ('error', 0), ('click', 1), ('signup', 2), ('purchase', 3), ('view', 4))
    SELECT entity_path, CAST(position AS BIGINT) AS position, entity_path = 'error' AS is_clock, count(*) AS n_rows
    FROM log JOIN spec USING (entity_path) GROUP BY ALL""",
)
def spec_paths_query(spark, sf):
    return select.paths_in_use(log(spark, sf), SPEC)


PATH_OF = {
    "click": "/joint_states/effort",
    "error": "/joint_states/position",
    "purchase": "/joint_states/velocity",
    "signup": "/info/eef_left",
    "view": "/video_stream/left_eye/current_frame",
}
PATH_SQL = "CASE entity_path " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in PATH_OF.items()) + " END"
TRAINING = {
    "/joint_states/effort": "effort",
    "/joint_states/position": "position",
    "/joint_states/velocity": "velocity",
    "/info/eef_left": "eef_left",
    "/info/eef_right": "eef_right",
    "/video_stream/left_eye/current_frame": "left_eye",
}


@query(
    "training_view",
    f"""{LOG}, robot AS (SELECT bag_id, {PATH_SQL} AS path, {HOUR_SQL} AS ts_ns, seq, value FROM log)
    SELECT bag_id, ts_ns, """
    + ", ".join(f"arg_max(value, seq) FILTER (path = '{p}') AS \"{c}\"" for p, c in TRAINING.items())
    + " FROM robot GROUP BY 1, 2",
)
def training_view_query(spark, sf):
    robot = log(spark, sf).select(
        "bag_id", F.expr(PATH_SQL).alias("entity_path"), F.expr(HOUR_SQL).alias("ts_ns"), "seq", "value"
    )
    return select.training_view(robot, "gripper", TRAINING)


# Which columns a recording (user and day) holds: the path by event type, the component by k.
PRESENCE_SQL = f"""presence AS (
  SELECT bag_id || '-' || (ts_ns // {DAY_NS}) AS bag_id, path AS entity_path,
    path || ':' || CASE path
      WHEN '/info/eef_left' THEN ['InstancePoses3D:translations', 'InstancePoses3D:quaternions', 'Scalars:scalars'][1 + k % 3]
      WHEN '/info/gripper_feedback_L' THEN ['std_msgs.msg.Float32MultiArray:message', 'Scalars:scalars', 'McapChannel:topic', 'Values:raw'][1 + k % 4]
      ELSE ['Scalars:scalars', 'McapMessage:data', 'Text:body'][1 + k % 3] END AS column_name
  FROM (SELECT *, CASE entity_path WHEN 'click' THEN '/info/eef_left' WHEN 'error' THEN '/info/gripper_feedback_L'
                  WHEN 'purchase' THEN '/joint_states/effort' ELSE '/info/eef_left' END AS path FROM log))"""


def presence(spark, sf):
    path = (
        F.when(F.col("entity_path") == "error", "/info/gripper_feedback_L")
        .when(F.col("entity_path") == "purchase", "/joint_states/effort")
        .otherwise("/info/eef_left")
    )
    def names(*items):
        return F.array(*[F.lit(i) for i in items])
    component = (
        F.when(F.col("path") == "/info/eef_left", F.get(names("InstancePoses3D:translations", "InstancePoses3D:quaternions", "Scalars:scalars"), (F.col("k") % 3).cast("int")))
        .when(F.col("path") == "/info/gripper_feedback_L", F.get(names("std_msgs.msg.Float32MultiArray:message", "Scalars:scalars", "McapChannel:topic", "Values:raw"), (F.col("k") % 4).cast("int")))
        .otherwise(F.get(names("Scalars:scalars", "McapMessage:data", "Text:body"), (F.col("k") % 3).cast("int")))
    )
    day = F.expr(f"ts_ns DIV {DAY_NS}").cast("string")
    return log(spark, sf).withColumn("path", path).select(
        F.concat_ws("-", F.col("bag_id").cast("string"), day).alias("bag_id"),
        F.col("path").alias("entity_path"),
        F.concat_ws(":", "path", component).alias("column_name"),
    )


@query(
    "pick_columns",
    f"""{LOG}, {PRESENCE_SQL}, ranked AS (
      SELECT DISTINCT bag_id, entity_path, column_name,
        CASE WHEN column_name LIKE '%:InstancePoses3D:translations' THEN 0
             WHEN column_name LIKE '%:InstancePoses3D:quaternions' THEN 1
             WHEN column_name LIKE '%:Float32MultiArray:message' OR column_name LIKE '%Float32MultiArray:message' THEN 0
             WHEN column_name LIKE '%:Scalars:scalars' THEN 2 END AS r FROM presence),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY bag_id, entity_path ORDER BY r) - 1 AS position FROM ranked WHERE r IS NOT NULL),
    other AS (SELECT bag_id, entity_path, 0 AS position, min(column_name) AS column_name FROM ranked
      WHERE r IS NULL AND column_name NOT LIKE '%Mcap%'
        AND (bag_id, entity_path) NOT IN (SELECT (bag_id, entity_path) FROM numbered) GROUP BY 1, 2)
    SELECT bag_id, entity_path, position, column_name FROM numbered
    WHERE position < CASE WHEN entity_path LIKE '/info/eef_%' THEN 2 ELSE 1 END
    UNION ALL SELECT bag_id, entity_path, position, column_name FROM other""",
)
def pick_columns_query(spark, sf):
    from robolog.contracts import column_preferences

    return select.pick_columns(presence(spark, sf), column_preferences("gripper"))


@query(
    "pick_state_columns",
    f"""{LOG}, {PRESENCE_SQL}, flags AS (
      SELECT bag_id, entity_path, bool_or(column_name LIKE '%:InstancePoses3D:translations') AS t,
        bool_or(column_name LIKE '%:InstancePoses3D:quaternions') AS q, bool_or(column_name LIKE '%:Scalars:scalars') AS s
      FROM presence WHERE entity_path LIKE '/info/%' GROUP BY 1, 2)
    SELECT bag_id, entity_path, CAST(0 AS BIGINT) AS position, entity_path || ':InstancePoses3D:translations' AS column_name
      FROM flags WHERE t AND q AND entity_path LIKE '/info/eef_%'
    UNION ALL SELECT bag_id, entity_path, 1, entity_path || ':InstancePoses3D:quaternions'
      FROM flags WHERE t AND q AND entity_path LIKE '/info/eef_%'
    UNION ALL SELECT bag_id, entity_path, 0, entity_path || ':Scalars:scalars'
      FROM flags WHERE s AND NOT (t AND q AND entity_path LIKE '/info/eef_%')""",
)
def pick_state_columns_query(spark, sf):
    from robolog.contracts import state_paths

    return select.pick_state_columns(presence(spark, sf), state_paths("gripper"))


@query(
    "nonnull_samples",
    f"""{LOG} SELECT bag_id, ts_ns, seq, props AS sample FROM log WHERE k % 10 <> 0""",
)
def nonnull_samples_query(spark, sf):
    frames = log(spark, sf).withColumn("sample", F.when(F.col("k") % 10 != 0, F.col("props")))
    return select.nonnull_samples(frames, ["bag_id", "ts_ns", "seq"])


@query(
    "first_sample",
    f"""{LOG} SELECT bag_id, entity_path, arg_min(seq, (ts_ns, seq)) AS seq, arg_min(k, (ts_ns, seq)) AS sample
        FROM log WHERE k % 3 <> 0 GROUP BY 1, 2
        UNION ALL SELECT bag_id, entity_path, NULL, NULL FROM log GROUP BY 1, 2 HAVING count(*) FILTER (k % 3 <> 0) = 0""",
)
def first_sample_query(spark, sf):
    frames = log(spark, sf).withColumn("sample", F.when(F.col("k") % 3 != 0, F.col("k")))
    return select.first_sample(frames, ["bag_id", "entity_path"], ["seq", "sample"])


@query(
    "all_null_topics",
    f"""{LOG} SELECT bag_id, entity_path, count(*) AS n_rows FROM log GROUP BY 1, 2
        HAVING count(CASE WHEN (bag_id + length(entity_path)) % 5 <> 0 AND k > 80 THEN value END) = 0""",
)
def all_null_topics_query(spark, sf):
    kept = ((F.col("bag_id") + F.length("entity_path")) % 5 != 0) & (F.col("k") > 80)
    return quality.all_null_topics(log(spark, sf).withColumn("value", F.when(kept, F.col("value"))))


@query(
    "stream_length_mismatch",
    f"""{LOG}, n AS (SELECT bag_id, count(*) FILTER (entity_path = 'click') AS a, count(*) FILTER (entity_path = 'error') AS b,
        count(*) FILTER (entity_path = 'purchase') AS c, count(*) FILTER (entity_path = 'signup') AS d
        FROM log WHERE entity_path <> 'view' GROUP BY 1)
    SELECT bag_id, least(a, b, c, d) AS shortest, greatest(a, b, c, d) AS longest FROM n WHERE least(a, b, c, d) <> greatest(a, b, c, d)""",
)
def stream_length_mismatch_query(spark, sf):
    return quality.stream_length_mismatch(camera_frames(spark, sf), CAMERAS)


SEGMENT_SQL = f"""parts AS (
  SELECT bag_id, bag_id || '-' || lpad(CAST(ts_ns // {DAY_NS} AS VARCHAR), 8, '0') AS segment_id,
         CASE WHEN k >= 60 THEN props END AS payload, ts_ns, seq, value FROM log)"""


def daily_segments(spark, sf):
    """Recordings by user, one segment per day; some segments hold no payload."""
    day = F.lpad(F.expr(f"ts_ns DIV {DAY_NS}").cast("string"), 8, "0")
    return log(spark, sf).select(
        "bag_id",
        F.concat_ws("-", F.col("bag_id").cast("string"), day).alias("segment_id"),
        F.when(F.col("k") >= 60, F.col("props")).alias("payload"),
        "ts_ns",
        "seq",
        "value",
    )


@query(
    "nonempty_segments",
    f"""{LOG}, {SEGMENT_SQL} SELECT segment_id, seq FROM parts
        WHERE segment_id IN (SELECT segment_id FROM parts WHERE payload IS NOT NULL)""",
)
def nonempty_segments_query(spark, sf):
    rows = daily_segments(spark, sf)
    segments = select.segment_table(rows, segment="segment_id")
    return select.nonempty_segments(rows, segments, "segment_id").select("segment_id", "seq")


@query(
    "max_segments",
    f"""{LOG}, {SEGMENT_SQL} SELECT segment_id, seq FROM parts
        WHERE segment_id IN (SELECT DISTINCT segment_id FROM parts ORDER BY segment_id LIMIT 100)""",
)
def max_segments_query(spark, sf):
    return select.first_segments(daily_segments(spark, sf), 100, "segment_id").select("segment_id", "seq")


@query(
    "last_segment",
    f"""{LOG}, {SEGMENT_SQL} SELECT bag_id, segment_id, seq FROM parts
        WHERE (bag_id, segment_id) IN (SELECT (bag_id, max(segment_id)) FROM parts GROUP BY bag_id)""",
)
def last_segment_query(spark, sf):
    rows = select.last_segment(daily_segments(spark, sf), "bag_id", "segment_id")
    return rows.select("bag_id", "segment_id", "seq")


@query(
    "set_difference",
    f"""{LOG} SELECT DISTINCT bag_id, ts_ns // {DAY_NS} AS day FROM log WHERE entity_path = 'click'
        EXCEPT SELECT bag_id, ts_ns // {DAY_NS} FROM log WHERE entity_path = 'view'""",
)
def set_difference_query(spark, sf):
    days = log(spark, sf).withColumn("day", F.expr(f"ts_ns DIV {DAY_NS}"))
    clicks = days.where(F.col("entity_path") == "click").select("bag_id", "day")
    views = days.where(F.col("entity_path") == "view").select("bag_id", "day")
    return quality.set_difference(clicks, views)


@query(
    "run_report",
    f"""{LOG}, b AS (SELECT bag_id, ts_ns // {DAY_NS} AS day, count(DISTINCT entity_path) >= 3 AS ok FROM log GROUP BY 1, 2)
    SELECT count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_failed FROM b""",
)
def run_report_query(spark, sf):
    days = log(spark, sf).withColumn("day", F.expr(f"ts_ns DIV {DAY_NS}"))
    bags = days.groupBy("bag_id", "day").agg((F.count_distinct("entity_path") >= 3).alias("ok"))
    return quality.run_report(bags)


NAMES_SQL = """names AS (
  SELECT bag_id, CASE WHEN bag_id % 4 = 0 THEN 'other' ELSE 'my_bag-' END || strftime(min(ts), '%y-%m-%d-%H-%M-%S') AS name
  FROM log GROUP BY bag_id)"""


def bag_names(spark, sf):
    first = log(spark, sf).groupBy("bag_id").agg(F.min("ts").alias("first"))
    prefix = F.when(F.col("bag_id") % 4 == 0, "other").otherwise("my_bag-")
    return first.select(
        "bag_id", F.concat(prefix, F.date_format("first", "yy-MM-dd-HH-mm-ss")).alias("name")
    )


@query(
    "bag_timestamp",
    f"""{LOG}, {NAMES_SQL}
    SELECT bag_id, CASE WHEN name LIKE 'my_bag-%' THEN substr(name, 8) ELSE name END AS bag_ts,
      CASE WHEN name LIKE 'my_bag-%' THEN CAST(epoch(strptime(substr(name, 8), '%y-%m-%d-%H-%M-%S')) AS BIGINT) END AS bag_epoch
    FROM names""",
)
def bag_timestamp_query(spark, sf):
    stamped = (
        bag_names(spark, sf)
        .withColumn("bag_ts", bag_timestamp(F.col("name")))
        .withColumn("stamp_us", ntz_micros(parse_bag_timestamp(F.col("bag_ts"))))
    )
    return stamped.select(
        "bag_id", "bag_ts", F.expr("stamp_us DIV 1000000").alias("bag_epoch")
    )


@query(
    "earliest_bag",
    f"""{LOG}, {NAMES_SQL} SELECT min(substr(name, 8)) AS bag_ts FROM names WHERE name LIKE 'my_bag-%'""",
)
def earliest_bag_query(spark, sf):
    named = bag_names(spark, sf).where(F.col("name").startswith("my_bag-"))
    return earliest_bag(named.withColumn("bag_ts", bag_timestamp(F.col("name"))))


@query(
    "frame_time",
    f"""{LOG}, anchor AS (SELECT bag_id, min(ts_ns) AS a FROM log GROUP BY bag_id)
    SELECT bag_id, seq, a + CAST(CAST((ts_ns - a) // 1000000 AS HUGEINT) * 1001 * 1000000000 // 30000 AS BIGINT) AS ts_ns
    FROM log JOIN anchor USING (bag_id)""",
)
def frame_time_query(spark, sf):
    from robolog.operators.joins import side_join

    rows = log(spark, sf)
    anchors = rows.groupBy("bag_id").agg(F.min("ts_ns").alias("anchor"))
    joined = side_join(rows, anchors, ["bag_id"])
    pts = F.expr("(ts_ns - anchor) DIV 1000000")
    at = frame_time(F.col("anchor"), pts, F.lit(1001), F.lit(30000))
    return joined.select("bag_id", "seq", at.alias("ts_ns"))


@query(
    "normalize_time",
    """SELECT event_id AS seq, epoch_us(ts) * 1000 AS from_timestamp, event_id * 7 AS from_integer,
       CAST(trunc(value * 1000000000.0) AS BIGINT) AS from_seconds,
       (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) * 1000 AS from_interval FROM events""",
)
def normalize_time_query(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        "ts",
        (F.col("event_id") * 7).alias("ticks"),
        "value",
        (F.col("ts") - F.lit("2024-01-01").cast("timestamp_ntz")).alias("span"),
    )
    def as_ns(name):
        return normalize_time(F.col(name), events.schema[name].dataType)
    return events.select(
        "seq",
        as_ns("ts").alias("from_timestamp"),
        as_ns("ticks").alias("from_integer"),
        as_ns("value").alias("from_seconds"),
        as_ns("span").alias("from_interval"),
    )


@query(
    "flatten_numeric",
    """SELECT event_id AS seq, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l) AS number FROM (
       SELECT event_id, list_concat([CAST(json_extract_string(props, '$.k') AS DOUBLE)], [value, CAST(user_id AS DOUBLE)]) AS l FROM events)""",
)
def flatten_numeric_query(spark, sf):
    """A nested payload built from the table, flattened by its schema."""
    payload = F.to_json(
        F.struct(
            F.struct(F.get_json_object("props", "$.k").alias("data"), F.lit(5).alias("ignored")).alias("a"),
            F.array(F.array("value"), F.array(F.col("user_id").cast("double"))).alias("b"),
        )
    )
    schema = "a STRUCT<data: STRING, ignored: INT>, b ARRAY<ARRAY<DOUBLE>>"
    numbers = table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), flatten_json(payload, schema).alias("n")
    )
    return numbers.select("seq", F.posexplode("n").alias("pos", "number")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@query(
    "video_shape",
    f"""{LOG}, f AS (SELECT bag_id, {CAMERA_SQL} AS camera, ts_ns, seq, k FROM log WHERE entity_path <> 'view')
    SELECT bag_id, camera, arg_min(480 + k, (ts_ns, seq)) FILTER (k % 4 <> 0) AS height, arg_min(640 + k, (ts_ns, seq)) FILTER (k % 4 <> 0) AS width,
      CAST(arg_min(3, (ts_ns, seq)) FILTER (k % 4 <> 0) AS BIGINT) AS channels
    FROM f GROUP BY 1, 2""",
)
def video_shape_query(spark, sf):
    frames = camera_frames(spark, sf).select(
        "bag_id", "camera", "ts_ns", "seq",
        F.when(F.col("k") % 4 != 0, F.col("sample")).alias("sample"),
        (F.col("k") + 480).alias("height"), (F.col("k") + 640).alias("width"),
        F.lit(3).cast("bigint").alias("channels"),
    )
    return video_shape(frames)


@query(
    "tile_geometry",
    f"""{LOG}, s AS (SELECT seq, k + 1 AS width, k // 2 + 1 AS height FROM log)
    SELECT seq, width, height, camera, r0, r1, c0, c1 FROM (
      SELECT seq, width, height, unnest(['left_eye', 'right_eye', 'left_wrist', 'right_wrist']) AS camera,
        unnest([0, 0, height // 2, height // 2]) AS r0, unnest([height // 2, height // 2, height, height]) AS r1,
        unnest([0, width // 2, 0, width // 2]) AS c0, unnest([width // 2, width, width // 2, width]) AS c1
      FROM s WHERE width >= 2 AND height >= 2)""",
)
def tile_geometry_query(spark, sf):
    sizes = log(spark, sf).select(
        "seq", (F.col("k") + 1).alias("width"), F.expr("k DIV 2 + 1").alias("height")
    )
    return tile_geometry(sizes)


@query(
    "inner_crop",
    f"""{LOG}, b AS (SELECT seq, k + 1 AS size, CAST(floor((k + 1) * 0.30::DOUBLE) AS BIGINT) AS s,
        k + 1 - CAST(floor((k + 1) * 0.28::DOUBLE) AS BIGINT) AS e FROM log),
    c AS (SELECT *, greatest(0, least(s, size - 1)) AS first FROM b)
    SELECT seq, size, first, greatest(first + 1, least(e, size)) AS "end" FROM c""",
)
def inner_crop_query(spark, sf):
    sizes = log(spark, sf).select("seq", (F.col("k") + 1).alias("size"))
    bounds = inner_bounds(F.col("size"), 0.30, 0.28)
    return sizes.withColumn("b", bounds).select("seq", "size", "b.first", "b.end")


@query(
    "publish_roundtrip",
    f"""{LOG} SELECT ts_ns // {DAY_NS} AS bag_id, count(*) AS n_rows, CAST(sum(seq) AS BIGINT) AS seq_sum,
        CAST(sum(CASE WHEN ts_ns // {DAY_NS} % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS version_sum FROM log GROUP BY 1""",
)
def publish_roundtrip(spark, sf):
    """Write a folder per recording (a day), replace some of them, read all back."""
    path = scratch_path(spark, "messages")
    rows = log(spark, sf).select(
        F.expr(f"ts_ns DIV {DAY_NS}").alias("bag_id"), "entity_path", "ts_ns", "seq", "value"
    )
    write_by_bag(rows.withColumn("version", F.lit(1)), path, mode="errorifexists")
    again = rows.where(F.col("bag_id") % 3 == 0).withColumn("version", F.lit(2))
    write_by_bag(again, path)
    return spark.read.parquet(path).groupBy(F.col("bag_id").cast("bigint").alias("bag_id")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("seq").alias("seq_sum"),
        F.sum("version").alias("version_sum"),
    )
