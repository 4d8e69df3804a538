"""Alignment, clocks and episodes over the message log."""

from __future__ import annotations

from pyspark.sql import functions as F

from robolog.operators import align, episodes, timeline
from robolog.operators.scan import last_value, scan
from robolog.operators.select import complete_rows
from robolog.plans.align import align_bags
from robolog.plans.dataset import episode_frames
from robolog.contracts import CAMERAS
from workload.log_scans import CAMERA_OF, DAY_NS, HOUR_SQL, camera_frames
from workload.registry import LOG, TOPICS, log, query

# A small cell size, so that the split plans run over the whole table as well.
SMALL_CELL = 24


def asof_sql(value: str = "value", clock: str = "view", topics=TOPICS, source: str = "log") -> str:
    """Latest-at as one ASOF join per topic."""
    joins = " ".join(
        f"""ASOF LEFT JOIN (SELECT bag_id, ts_ns, {value} AS v FROM {source} WHERE entity_path = '{path}') t{i}
        ON c.bag_id = t{i}.bag_id AND c.ts_ns >= t{i}.ts_ns"""
        for i, path in enumerate(topics)
    )
    picked = ", ".join(f't{i}.v AS "{name}"' for i, name in enumerate(topics.values()))
    return f"""SELECT c.bag_id, c.ts_ns, c.seq, {picked}
      FROM (SELECT * FROM {source} WHERE entity_path = '{clock}') c {joins}"""


@query("asof_align", f"{LOG} {asof_sql()}")
def asof_align(spark, sf):
    return align.asof_align_log(log(spark, sf), "view", TOPICS)


@query("asof_align_split", f"{LOG} {asof_sql()}")
def asof_align_split(spark, sf):
    """The same result when recordings are cut into cells."""
    rows = log(spark, sf)
    clock = rows.where(F.col("entity_path") == "view").select("bag_id", "ts_ns", "seq")
    return align.asof_align(clock, rows, TOPICS, target_rows=SMALL_CELL)


@query(
    "complete_rows",
    f"{LOG}, a AS ({asof_sql()}) SELECT * FROM a WHERE click IS NOT NULL AND error IS NOT NULL "
    "AND purchase IS NOT NULL AND signup IS NOT NULL",
)
def complete_rows_query(spark, sf):
    return complete_rows(asof_align(spark, sf), list(TOPICS.values()))


HOURLY = f"""hourly AS (SELECT bag_id, entity_path, {HOUR_SQL} AS ts_ns, seq, CASE WHEN k % 7 <> 0 THEN value END AS value, k FROM log)"""


def hourly(spark, sf):
    """Times cut to the hour, so topics share instants and repeat; some values are null."""
    return log(spark, sf).select(
        "bag_id", "entity_path", F.expr(HOUR_SQL).alias("ts_ns"), "seq",
        F.when(F.col("k") % 7 != 0, F.col("value")).alias("value"), "k",
    )


@query(
    "dedup_last",
    f"""{LOG}, {HOURLY} SELECT bag_id, ts_ns, arg_max(value, seq) FILTER (value IS NOT NULL) AS value,
        max(seq * 0 + k) FILTER (seq = m) AS k
        FROM (SELECT *, max(seq) OVER (PARTITION BY bag_id, ts_ns) AS m FROM hourly) GROUP BY 1, 2""",
)
def dedup_last(spark, sf):
    return align.dedup_last(hourly(spark, sf), ["bag_id", "ts_ns"], ["value", "k"])


def exact_fill(spark, sf, **options):
    rows = hourly(spark, sf).withColumn("ts_ns", F.expr(f"ts_ns - ts_ns % {DAY_NS}"))
    expected = rows.where("entity_path IN ('view', 'click')").select("bag_id", "ts_ns").distinct()
    readings = rows.where("entity_path NOT IN ('view', 'click')")
    return align.align_exact_fill(expected, readings, ["value", "k"], **options)


FILL_SQL = f"""{LOG}, {HOURLY},
  d AS (SELECT bag_id, entity_path, ts_ns - ts_ns % {DAY_NS} AS ts_ns, seq, value, k FROM hourly),
  e AS (SELECT DISTINCT bag_id, ts_ns FROM d WHERE entity_path IN ('view', 'click')),
  u AS (SELECT bag_id, ts_ns, arg_max(value, seq) FILTER (value IS NOT NULL) AS value, arg_max(k, seq) AS k
        FROM d WHERE entity_path NOT IN ('view', 'click') GROUP BY 1, 2),
  j AS (SELECT e.bag_id, e.ts_ns, value, k FROM e LEFT JOIN u ON e.bag_id = u.bag_id AND e.ts_ns = u.ts_ns)
  SELECT bag_id, ts_ns,
    coalesce(last_value(value IGNORE NULLS) OVER b, first_value(value IGNORE NULLS) OVER f) AS value,
    coalesce(last_value(k IGNORE NULLS) OVER b, first_value(k IGNORE NULLS) OVER f) AS k FROM j
  WINDOW b AS (PARTITION BY bag_id ORDER BY ts_ns ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY bag_id ORDER BY ts_ns ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


@query("align_exact_fill", FILL_SQL)
def align_exact_fill(spark, sf):
    return exact_fill(spark, sf)


@query("align_exact_fill_split", FILL_SQL)
def align_exact_fill_split(spark, sf):
    return exact_fill(spark, sf, target_rows=5)


WIDE_SQL = ", ".join(f"CASE WHEN entity_path = '{p}' THEN value END AS \"{c}\"" for p, c in TOPICS.items())


@query(
    "ffill",
    f"""{LOG}, w AS (SELECT bag_id, ts_ns, seq, {WIDE_SQL} FROM log)
    SELECT bag_id, ts_ns, seq, """
    + ", ".join(f'last_value("{c}" IGNORE NULLS) OVER b AS "{c}"' for c in TOPICS.values())
    + " FROM w WINDOW b AS (PARTITION BY bag_id ORDER BY ts_ns, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
)
def ffill(spark, sf):
    wide = log(spark, sf).select(
        "bag_id", "ts_ns", "seq",
        *[F.when(F.col("entity_path") == p, F.col("value")).alias(c) for p, c in TOPICS.items()],
    )
    return align.forward_fill(wide, list(TOPICS.values()))


STEP_SQL = f"{LOG} SELECT bag_id, entity_path, ts_ns, seq, ts_ns - lag(ts_ns) OVER (PARTITION BY bag_id, entity_path ORDER BY ts_ns, seq) AS step_ns FROM log"


def steps(spark, sf, **options):
    rows = log(spark, sf).select("bag_id", "entity_path", "ts_ns", "seq")
    return timeline.time_steps(rows, ["bag_id", "entity_path"], **options)


@query("time_steps", STEP_SQL)
def time_steps(spark, sf):
    return steps(spark, sf)


@query("time_steps_split", STEP_SQL)
def time_steps_split(spark, sf):
    return steps(spark, sf, target_rows=5)


# The log at a thousandfold pace: a message every few hundredths of a second.
FAST = "fast AS (SELECT bag_id, entity_path, ts_ns // 1000000 AS ts_ns, seq, value, k FROM log)"
MEDIAN_SQL = f"""{LOG}, {FAST},
  s AS (SELECT bag_id, ts_ns - lag(ts_ns) OVER (PARTITION BY bag_id ORDER BY ts_ns, seq) AS d FROM fast)"""


def fast(spark, sf):
    return log(spark, sf).withColumn("ts_ns", F.expr("ts_ns DIV 1000000"))


FPS_SQL = f"""{MEDIAN_SQL},
  m AS (SELECT bag_id, CAST(trunc(median(d)) AS BIGINT) AS md FROM s WHERE d > 0 GROUP BY bag_id)
  SELECT n.bag_id, n_times, md AS median_step_ns, CAST(round_even(1e9::DOUBLE / md, 0) AS BIGINT) AS fps,
    CASE WHEN n_times < 2 THEN 'too few timestamps' WHEN md IS NULL THEN 'no positive step' ELSE 'ok' END AS status
  FROM (SELECT bag_id, count(*) AS n_times FROM fast GROUP BY 1) n LEFT JOIN m ON n.bag_id = m.bag_id"""


@query("infer_fps", FPS_SQL)
def infer_fps(spark, sf):
    return timeline.infer_fps(fast(spark, sf), ["bag_id"])


@query("infer_fps_split", FPS_SQL)
def infer_fps_split(spark, sf):
    return timeline.infer_fps(fast(spark, sf), ["bag_id"], target_rows=SMALL_CELL)


@query(
    "fps_check",
    f"""{MEDIAN_SQL}, m AS (SELECT bag_id, median(d) AS md FROM s WHERE d IS NOT NULL GROUP BY bag_id),
    f AS (SELECT n.bag_id, n.c, CASE WHEN n.c < 2 THEN 0.0::DOUBLE ELSE 1e9::DOUBLE / nullif(md, 0) END AS fps
      FROM (SELECT bag_id, count(*) AS c FROM fast GROUP BY 1) n LEFT JOIN m ON n.bag_id = m.bag_id)
    SELECT bag_id, round(fps, 6) AS source_fps, coalesce(abs(fps - 40) / 40 <= 0.05, false) AND c >= 2 AS keeps_rate FROM f""",
)
def fps_check(spark, sf):
    checked = timeline.fps_check(fast(spark, sf), ["bag_id"], 40)
    return checked.withColumn("source_fps", F.round("source_fps", 6))


SIX_HOURS = 6 * 3600 * 1_000_000_000
GRID_SQL = f"""bounds AS (SELECT bag_id, min(ts_ns) AS lo, max(ts_ns) AS hi FROM log GROUP BY bag_id),
  grid AS (SELECT bag_id, grid_no, lo + grid_no * {SIX_HOURS} AS ts_ns FROM (
    SELECT *, unnest(range(0, greatest((hi - lo + {SIX_HOURS} - 1) // {SIX_HOURS}, 1))) AS grid_no FROM bounds))"""


@query("time_grid", f"{LOG}, {GRID_SQL} SELECT bag_id, grid_no, ts_ns FROM grid")
def time_grid(spark, sf):
    return timeline.time_grid(log(spark, sf), 1e9 / SIX_HOURS)


@query(
    "grid_resample",
    f"""{LOG}, {GRID_SQL}, ticks AS (SELECT bag_id, 'grid' AS entity_path, ts_ns, grid_no AS seq, NULL::DOUBLE AS value FROM grid
        UNION ALL SELECT bag_id, entity_path, ts_ns, seq, value FROM log),
      a AS ({asof_sql(clock='grid', source='ticks')})
      SELECT bag_id, seq AS grid_no, ts_ns, click, error, purchase, signup FROM a""",
)
def grid_resample(spark, sf):
    return timeline.grid_resample(log(spark, sf), 1e9 / SIX_HOURS, TOPICS)


FRAME_NO = "row_number() OVER (PARTITION BY bag_id, camera ORDER BY ts_ns, seq) - 1"
# Every reading gives a frame of each camera; some recordings lose frames of one.
LOST_FRAME = "camera = 'right_wrist' AND bag_id % 5 = 0 AND k < 10"
TAKES_SQL = f"""takes AS (SELECT * FROM (SELECT bag_id, ts_ns, seq, value * (1 + i) AS value, k,
      ['left_eye', 'right_eye', 'left_wrist', 'right_wrist'][i + 1] AS camera FROM log, unnest([0, 1, 2, 3]) t(i)) WHERE NOT ({LOST_FRAME})),
    lengths AS (SELECT bag_id, min(n) AS shortest, max(n) AS longest FROM (
      SELECT bag_id, count(*) FILTER (camera = c) AS n FROM takes, unnest(['left_eye', 'right_eye', 'left_wrist', 'right_wrist']) u(c) GROUP BY bag_id, c) GROUP BY 1)"""
ZIP_SQL = f"""{LOG}, {TAKES_SQL}, n AS (SELECT bag_id, camera, value, {FRAME_NO} AS frame_no
    FROM takes WHERE bag_id IN (SELECT bag_id FROM lengths WHERE shortest = longest))
  SELECT a.bag_id, a.frame_no, a.value AS left_eye, b.value AS right_eye, c.value AS left_wrist, d.value AS right_wrist
  FROM n a JOIN n b ON a.bag_id = b.bag_id AND a.frame_no = b.frame_no AND a.camera = 'left_eye' AND b.camera = 'right_eye'
  JOIN n c ON a.bag_id = c.bag_id AND a.frame_no = c.frame_no AND c.camera = 'left_wrist'
  JOIN n d ON a.bag_id = d.bag_id AND a.frame_no = d.frame_no AND d.camera = 'right_wrist'"""


def camera_takes(spark, sf):
    cameras = F.array(*[F.lit(c) for c in CAMERAS])
    takes = log(spark, sf).select("bag_id", "ts_ns", "seq", "value", "k", F.posexplode(cameras).alias("i", "camera"))
    return takes.withColumn("value", F.col("value") * (F.col("i") + 1)).where(f"NOT ({LOST_FRAME})").drop("i")


@query("camera_zip", ZIP_SQL)
def camera_zip(spark, sf):
    return align.camera_zip(camera_takes(spark, sf), {c: c for c in CAMERAS})


@query(
    "frame_lookup",
    f"""{LOG}, c AS ({asof_sql(value='props')}), """
    + ", ".join(
        f"f_{c} AS (SELECT bag_id, arg_min(props, (ts_ns, seq)) AS first FROM log WHERE entity_path = '{c}' GROUP BY 1)" for c in TOPICS
    )
    + " "
    + " UNION ALL ".join(
        f"""SELECT c.bag_id, '{CAMERA_OF[c]}' AS camera, c.ts_ns, c.seq, coalesce(c.{c}, f_{c}.first) AS sample
        FROM c LEFT JOIN f_{c} ON c.bag_id = f_{c}.bag_id"""
        for c in TOPICS
    ),
)
def frame_lookup(spark, sf):
    """The sample of every camera at each view: a clock per (recording, camera)."""
    rows = log(spark, sf)
    stream = F.struct("bag_id", "camera").alias("stream")
    cameras = F.explode(F.array(*[F.lit(c) for c in CAMERA_OF.values()])).alias("camera")
    clock = rows.where("entity_path = 'view'").select("bag_id", "ts_ns", "seq", cameras).select(stream, "ts_ns", "seq")
    samples = camera_frames(spark, sf).select(stream, "ts_ns", "seq", F.col("props").alias("sample"))
    key = F.concat_ws("/", F.col("stream.bag_id").cast("string"), "stream.camera")
    found = align.frame_lookup(clock.withColumn("stream", key), samples.withColumn("stream", key), bag="stream")
    return found.select(
        F.split_part("stream", F.lit("/"), F.lit(1)).cast("bigint").alias("bag_id"),
        F.split_part("stream", F.lit("/"), F.lit(2)).alias("camera"), "ts_ns", "seq", "sample",
    )


@query(
    "collapse_repeats",
    f"""{LOG}, r AS (SELECT bag_id, ts_ns, seq * 4 + rep AS seq, value FROM log, unnest([0, 1, 2]) AS t(rep)
        WHERE NOT (bag_id % 7 = 0 AND rep = 1 AND k = 50)),
      n AS (SELECT *, row_number() OVER (PARTITION BY bag_id ORDER BY ts_ns, seq) AS rn, count(*) OVER (PARTITION BY bag_id) AS c FROM r),
      e AS (SELECT bag_id, count(*) AS expected FROM log GROUP BY bag_id)
    SELECT n.bag_id, ts_ns, seq, value FROM n JOIN e ON n.bag_id = e.bag_id
    WHERE c % expected = 0 AND (rn - 1) % (c // expected) = 0""",
)
def collapse_repeats(spark, sf):
    """Each reading three times; some recordings lose one copy and cannot be aligned."""
    return align.collapse_repeats(*repeats(spark, sf))


def repeats(spark, sf):
    rows = log(spark, sf)
    repeated = (
        rows.withColumn("rep", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .where("NOT (bag_id % 7 = 0 AND rep = 1 AND k = 50)")
        .select("bag_id", "ts_ns", F.expr("seq * 4 + rep").alias("seq"), "value")
    )
    expected = rows.groupBy("bag_id").agg(F.count(F.lit(1)).alias("expected"))
    return repeated, expected


@query(
    "rejected_recordings",
    f"""{LOG}, {TAKES_SQL}, r AS (SELECT bag_id FROM log, unnest([0, 1, 2]) AS t(rep) WHERE NOT (bag_id % 7 = 0 AND rep = 1 AND k = 50)),
      e AS (SELECT bag_id, count(*) AS expected FROM log GROUP BY 1), n AS (SELECT bag_id, count(*) AS n_rows FROM r GROUP BY 1)
    SELECT bag_id, 'cameras differ in length' AS reason, shortest AS found, longest AS wanted FROM lengths WHERE shortest <> longest
    UNION ALL SELECT bag_id, 'no multiple of the expected rows', n_rows, expected FROM n JOIN e USING (bag_id) WHERE n_rows % expected <> 0""",
)
def rejected_recordings(spark, sf):
    """What the camera zip and the collapsing of repeats leave out, with the reason."""
    cameras = align.unequal_cameras(camera_takes(spark, sf), CAMERAS).select(
        "bag_id", F.lit("cameras differ in length").alias("reason"), F.col("shortest").alias("found"), F.col("longest").alias("wanted"))
    uneven = align.uneven_repeats(*repeats(spark, sf)).select(
        "bag_id", F.lit("no multiple of the expected rows").alias("reason"), F.col("n_rows").alias("found"), F.col("expected").alias("wanted"))
    return cameras.unionByName(uneven)


# The stateful loop itself, as a recursive table over frame numbers.
DOWNSAMPLE_SQL = f"""WITH RECURSIVE log AS (
    SELECT user_id AS bag_id, epoch_us(ts) * 1000 AS ts_ns, event_id AS seq FROM events),
  n AS (SELECT *, row_number() OVER (PARTITION BY bag_id ORDER BY ts_ns, seq) - 1 AS frame_no FROM log),
  longest AS (SELECT max(frame_no) AS last FROM n),
  loop(i, keep, due) AS (
    SELECT CAST(0 AS BIGINT), true, 1.0::DOUBLE / 12.0::DOUBLE
    UNION ALL
    SELECT i + 1, (i + 1) / 29.97::DOUBLE + 1e-9::DOUBLE >= due,
      CASE WHEN (i + 1) / 29.97::DOUBLE + 1e-9::DOUBLE >= due THEN due + 1.0::DOUBLE / 12.0::DOUBLE ELSE due END
    FROM loop, longest WHERE i < last)
  SELECT bag_id, ts_ns, seq, frame_no FROM n JOIN loop ON frame_no = i WHERE keep"""


@query("downsample_fps", DOWNSAMPLE_SQL)
def downsample_fps(spark, sf):
    frames = log(spark, sf).select("bag_id", "ts_ns", "seq")
    return timeline.downsample_fps(frames, 29.97, 12.0)


# The same loop for each source rate; recordings have one of three, some none (30 then).
RATES_SQL = """WITH RECURSIVE log AS (
    SELECT user_id AS bag_id, epoch_us(ts) * 1000 AS ts_ns, event_id AS seq, [29.97::DOUBLE, 60::DOUBLE, 24::DOUBLE, 0::DOUBLE][1 + user_id % 4] AS fps FROM events),
  n AS (SELECT *, row_number() OVER (PARTITION BY bag_id ORDER BY ts_ns, seq) - 1 AS frame_no FROM log),
  longest AS (SELECT max(frame_no) AS last FROM n),
  loop(fps, i, keep, due) AS (
    SELECT fps, CAST(0 AS BIGINT), true, 1.0::DOUBLE / 12.0::DOUBLE FROM unnest([29.97::DOUBLE, 60::DOUBLE, 24::DOUBLE, 30::DOUBLE]) t(fps)
    UNION ALL
    SELECT fps, i + 1, (i + 1) / fps + 1e-9::DOUBLE >= due,
      CASE WHEN (i + 1) / fps + 1e-9::DOUBLE >= due THEN due + 1.0::DOUBLE / 12.0::DOUBLE ELSE due END
    FROM loop, longest WHERE i < last)
  SELECT bag_id, ts_ns, seq, n.fps, frame_no FROM n JOIN loop ON frame_no = i AND loop.fps = CASE WHEN n.fps > 0 THEN n.fps ELSE 30 END WHERE keep"""


@query("downsample_rates", RATES_SQL)
def downsample_rates(spark, sf):
    """Every recording thinned from its own rate."""
    rate = F.element_at(F.array(*[F.lit(r) for r in (29.97, 60.0, 24.0, 0.0)]), (F.col("bag_id") % 4 + 1).cast("int"))
    frames = log(spark, sf).select("bag_id", "ts_ns", "seq", rate.alias("fps"))
    return timeline.downsample_fps(frames, "fps", 12.0)


@query("downsample_fps_split", DOWNSAMPLE_SQL)
def downsample_fps_split(spark, sf):
    frames = log(spark, sf).select("bag_id", "ts_ns", "seq")
    return timeline.downsample_fps(frames, 29.97, 12.0, target_rows=SMALL_CELL)


@query(
    "relative_time",
    f"""{LOG} SELECT bag_id, seq, CAST((ts_ns - min(ts_ns) OVER (PARTITION BY bag_id)) / 1000000000.0::DOUBLE AS FLOAT) AS timestamp FROM log""",
)
def relative_time(spark, sf):
    return timeline.relative_time(log(spark, sf)).select("bag_id", "seq", "timestamp")


@query(
    "sort_clean_index",
    f"""{LOG}, t AS (SELECT bag_id, seq, CASE k % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') WHEN 1 THEN 'not a time' END AS stamp, ts FROM log)
    SELECT bag_id, seq, stamp, epoch_us(ts) * 1000 AS ts_ns FROM t WHERE stamp IS NOT NULL AND stamp <> 'not a time'""",
)
def sort_clean_index(spark, sf):
    rows = log(spark, sf).select(
        "bag_id",
        "seq",
        F.when(F.col("k") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(F.col("k") % 3 == 1, F.lit("not a time"))
        .alias("stamp"),
    )
    return align.sort_clean_index(rows, "stamp", ["bag_id"])


EPISODE_ROWS = f"""a AS ({asof_sql(value='[CAST(value AS FLOAT), CAST(k AS FLOAT)]')}),
  t AS (SELECT a.*, CASE WHEN l.k % 9 = 0 THEN NULL ELSE 'task ' || (l.k % 4) END AS text
        FROM a JOIN log l ON a.seq = l.seq),
  rows AS (SELECT 'bag-' || bag_id AS segment_id, ts_ns, seq, coalesce(text, 'task') AS task, click, error, purchase, signup FROM t
        WHERE click IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL AND signup IS NOT NULL),
  ep AS (SELECT segment_id, count(*) AS length, min(ts_ns) AS first_ns FROM rows GROUP BY 1),
  eps AS (SELECT *, row_number() OVER (ORDER BY segment_id) - 1 AS episode_index,
          CAST(coalesce(sum(length) OVER (ORDER BY segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_index FROM ep),
  tasks AS (SELECT task, row_number() OVER (ORDER BY f) - 1 AS task_index FROM (
          SELECT task, min((segment_id, ts_ns, seq)) AS f FROM rows GROUP BY 1)),
  num AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY ts_ns, seq) - 1 AS frame_index FROM rows)"""


def episode_rows(spark, sf):
    """Aligned rows per recording, with task text on the clock rows."""
    rows = log(spark, sf)
    clock = rows.where("entity_path = 'view'").select(
        "bag_id", "ts_ns", "seq",
        F.when(F.col("k") % 9 != 0, F.concat(F.lit("task "), (F.col("k") % 4).cast("string"))).alias("text"),
    )
    vectors = rows.select(
        "bag_id", "entity_path", "ts_ns", "seq",
        F.array(F.col("value").cast("float"), F.col("k").cast("float")).alias("values"),
    )
    aligned = align.asof_align(clock, vectors, TOPICS, value="values")
    return aligned.withColumn(
        "segment_id", F.concat(F.lit("bag-"), F.col("bag_id").cast("string"))
    )


FRAMES_SQL = f"""{LOG}, {EPISODE_ROWS}
  SELECT num.segment_id, episode_index, frame_index, first_index + frame_index AS index,
    CAST((ts_ns - first_ns) / 1000000000.0::DOUBLE AS FLOAT) AS timestamp, task, task_index,
    click[1]::DOUBLE AS a0, click[2]::DOUBLE AS a1, error[1]::DOUBLE AS a2, error[2]::DOUBLE AS a3,
    purchase[1]::DOUBLE AS s0, purchase[2]::DOUBLE AS s1, signup[1]::DOUBLE AS s2, signup[2]::DOUBLE AS s3
  FROM num JOIN eps ON num.segment_id = eps.segment_id JOIN tasks USING (task)"""


def frames_with(spark, sf, **options):
    frames, _, _ = episode_frames(
        episode_rows(spark, sf), ["click", "error"], ["purchase", "signup"], task="text", stage=True, **options
    )
    return frames.select(
        "segment_id", "episode_index", "frame_index", "index", "timestamp", "task", "task_index",
        *[F.get("action", F.lit(i)).cast("double").alias(f"a{i}") for i in range(4)],
        *[F.get("observation_state", F.lit(i)).cast("double").alias(f"s{i}") for i in range(4)],
    )


@query("episode_frames", FRAMES_SQL)
def episode_frames_query(spark, sf):
    return frames_with(spark, sf)


@query("episode_frames_split", FRAMES_SQL)
def episode_frames_split(spark, sf):
    return frames_with(spark, sf, target_rows=5)


@query(
    "episode_index",
    f"""{LOG}, n AS (SELECT 'bag-' || bag_id AS segment_id, count(*) FILTER (k > 95 AND entity_path = 'view') AS n_rows FROM log GROUP BY 1)
    SELECT segment_id, n_rows, row_number() OVER (ORDER BY segment_id) - 1 AS episode_index FROM n WHERE n_rows > 0""",
)
def episode_index(spark, sf):
    """Segments without rows get no number."""
    rows = log(spark, sf)
    counts = rows.groupBy(F.concat(F.lit("bag-"), F.col("bag_id").cast("string")).alias("segment_id")).agg(
        F.count_if((F.col("k") > 95) & (F.col("entity_path") == "view")).alias("n_rows")
    )
    return episodes.episode_index(counts)


@query(
    "episode_metadata",
    f"""{LOG}, {EPISODE_ROWS} SELECT eps.segment_id, episode_index, length, first_index, first_ns, n_tasks
    FROM eps JOIN (SELECT segment_id, count(DISTINCT task) AS n_tasks FROM rows GROUP BY 1) x ON eps.segment_id = x.segment_id""",
)
def episode_metadata(spark, sf):
    frames, table, _ = episode_frames(
        episode_rows(spark, sf), ["click", "error"], ["purchase", "signup"], task="text", stage=True
    )
    tasks = episodes.episode_tasks(frames, order=("frame_index",))
    n_tasks = tasks.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n_tasks"))
    return table.join(n_tasks, "segment_id")


@query(
    "chunk_assignment",
    f"""{LOG}, e AS (SELECT bag_id AS episode_index, CAST(sum(octet_length(encode(props)) * 300) AS BIGINT) AS size_bytes FROM log GROUP BY 1),
      b AS (SELECT *, CAST(coalesce(sum(size_bytes) OVER (ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bytes_before FROM e),
      f AS (SELECT *, CAST(floor(bytes_before / 1048576.0::DOUBLE) AS BIGINT) AS f FROM b)
    SELECT episode_index, size_bytes, bytes_before, f // 5 AS chunk_index, f % 5 AS file_index,
      printf('data/chunk-%03d/file-%03d.parquet', f // 5, f % 5) AS path FROM f""",
)
def chunk_assignment(spark, sf):
    sizes = log(spark, sf).groupBy(F.col("bag_id").alias("episode_index")).agg(
        F.sum(F.octet_length("props").cast("bigint") * 300).alias("size_bytes")
    )
    return episodes.file_assignment(sizes, target_mb=1.0, files_per_chunk=5)


ALIGN_TARGETS = {"signup": 3, "click": 1}


@query(
    "align_bags",
    f"""{LOG}, a AS ({asof_sql(value='[CAST(value AS FLOAT), CAST(k AS FLOAT)]')}),
      good AS (SELECT bag_id FROM a GROUP BY 1 HAVING count(click) > 0 AND count(error) > 0 AND count(purchase) > 0 AND count(signup) > 0)
    SELECT bag_id, ts_ns, seq, """
    + ", ".join(
        f"coalesce({c}[{i + 1}], 0)::DOUBLE AS {c}{i}" for c in TOPICS.values() for i in range(2)
    )
    + ", 0::DOUBLE AS signup2 FROM a WHERE bag_id IN (SELECT bag_id FROM good)",
)
def align_bags_query(spark, sf):
    rows = log(spark, sf)
    clock = rows.where("entity_path = 'view'").select("bag_id", "ts_ns", "seq")
    vectors = rows.select(
        "bag_id", "entity_path", "ts_ns", "seq",
        F.array(F.col("value"), F.col("k").cast("double")).alias("values"),
    )
    frames = align_bags(clock, vectors, TOPICS, ALIGN_TARGETS, stage=True).frames
    numbers = [(c, i) for c in TOPICS.values() for i in range(2)] + [("signup", 2)]
    return frames.select(
        "bag_id", "ts_ns", "seq", *[F.get(c, F.lit(i)).cast("double").alias(f"{c}{i}") for c, i in numbers]
    )
