"""Images, packets and task text over pages, documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from robolog.functions.images import codec_from_bytes, codec_from_name, image_bytes, media_type
from robolog.functions.numeric import extract_numbers
from robolog.functions.times import task_text
from robolog.operators import episodes, images
from robolog.plans.align import align_images
from robolog.session import scratch_path
from robolog.sinks.publish import write_by_bag
from workload.registry import query, table

# --- pages as images: a host is a recording, page_id its clock --------------------------

# The file signature a page gets, by page number.
MAGIC = ["FFD8FF", "89504E470D0A1A0A", "524946460000000057454250", "00000001", ""]
HINTS = ["cdr", " ", "sensor/JPEG; x", "image/png", "h264"]

PAGES = f"""WITH pages_blob AS (
  SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS bag_id, page_id AS ts_ns, page_id AS seq, html,
    {MAGIC!r}[1 + page_id % 5] || hex(encode(html)) AS hx,
    CASE WHEN page_id % 3 = 0 THEN NULL ELSE {HINTS!r}[1 + length(url) % 5] END AS encoding FROM pages)"""


def choose(items, index):
    return F.get(F.array(*[F.lit(i) for i in items]), index.cast("int"))


def page_images(spark, sf):
    pages = table(spark, sf, "pages")
    magic = F.unhex(choose(MAGIC, F.col("page_id") % 5))
    return pages.select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("bag_id"),
        F.col("page_id").alias("ts_ns"),
        F.col("page_id").alias("seq"),
        "html",
        F.concat(magic, F.encode("html", "UTF-8")).alias("blob"),
        F.when(F.col("page_id") % 3 != 0, choose(HINTS, F.length("url") % 5)).alias("encoding"),
    )


@query(
    "image_bytes",
    """SELECT page_id, CASE WHEN page_id % 4 = 3 THEN NULL ELSE md5(html) END AS digest,
       CASE WHEN page_id % 4 = 3 THEN NULL ELSE octet_length(encode(html)) END AS n_bytes
       FROM (SELECT page_id, regexp_replace(html, '^\\s+|\\s+$', '', 'g') AS html FROM pages)""",
)
def image_bytes_query(spark, sf):
    """The same bytes stored as text, as base64, inside a struct, and not at all."""
    pages = table(spark, sf, "pages")
    trimmed = F.regexp_replace("html", r"(?U)^\s+|\s+$", "")
    encoded = F.regexp_replace(F.base64(F.encode(trimmed, "UTF-8")), r"\s", "")
    kind = F.col("page_id") % 4
    stored = pages.select(
        "page_id",
        F.when(kind == 0, F.col("html")).when(kind == 1, encoded).when(kind == 3, F.lit("")).alias("as_text"),
        F.struct(
            F.lit(7).alias("size"), F.when(kind == 2, F.encode(trimmed, "UTF-8")).alias("blob")
        ).alias("as_struct"),
    )
    def data(name):
        return image_bytes(F.col(name), stored.schema[name].dataType)
    found = stored.select("page_id", F.coalesce(data("as_text"), data("as_struct")).alias("b"))
    return found.select("page_id", F.md5("b").alias("digest"), F.octet_length("b").cast("bigint").alias("n_bytes"))


NAME_CODEC = """CASE WHEN lower(encoding) LIKE '%jpeg%' OR lower(encoding) LIKE '%jpg%' THEN 'jpeg' WHEN lower(encoding) LIKE '%png%' THEN 'png'
  WHEN lower(encoding) LIKE '%webp%' THEN 'webp' WHEN lower(encoding) LIKE '%h264%' OR lower(encoding) LIKE '%mp4%' THEN 'h264' END"""
BYTE_CODEC = """CASE WHEN hx LIKE 'FFD8FF%' THEN 'jpeg' WHEN hx LIKE '89504E470D0A1A0A%' THEN 'png'
  WHEN hx LIKE '52494646%' AND substr(hx, 17, 8) = '57454250' THEN 'webp' WHEN hx LIKE '00000001%' OR hx LIKE '000001%' THEN 'h264' ELSE 'jpeg' END"""
MEDIA = "CASE codec WHEN 'jpeg' THEN 'image/jpeg' WHEN 'png' THEN 'image/png' WHEN 'webp' THEN 'image/webp' ELSE 'application/octet-stream' END"
CODECS = f"""codecs AS (SELECT n.bag_id, coalesce({NAME_CODEC.replace('encoding', 'n.encoding')}, {BYTE_CODEC.replace('hx', 'h.hx')}) AS codec
  FROM (SELECT bag_id, arg_min(encoding, seq) FILTER (trim(encoding) <> '') AS encoding FROM pages_blob GROUP BY 1) n
  JOIN (SELECT bag_id, arg_min(hx, seq) FILTER (length(hx) > 0) AS hx FROM pages_blob GROUP BY 1) h USING (bag_id))"""


@query("image_codec", f"{PAGES}, {CODECS} SELECT bag_id, codec FROM codecs")
def image_codec(spark, sf):
    return images.image_codec(page_images(spark, sf))


@query(
    "media_type",
    f"""{PAGES}, c AS (SELECT seq, coalesce({NAME_CODEC}, {BYTE_CODEC}) AS codec FROM pages_blob)
    SELECT seq, codec, {MEDIA} AS media_type FROM c""",
)
def media_type_query(spark, sf):
    codec = F.coalesce(codec_from_name(F.col("encoding")), codec_from_bytes(F.col("blob")))
    rows = page_images(spark, sf).select("seq", codec.alias("codec"))
    return rows.withColumn("media_type", media_type(F.col("codec")))


CARRY_SQL = f"""{PAGES}, g AS (SELECT bag_id, seq, CASE WHEN length(html) % 3 = 0 THEN hx END AS hx FROM pages_blob)
    SELECT bag_id, seq, md5(unhex(coalesce(last_value(hx IGNORE NULLS) OVER (PARTITION BY bag_id ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ''))) AS digest FROM g"""


def sparse_images(spark, sf):
    """Images with gaps: empty bytes or null where the text length is no multiple of 3."""
    kind = F.length("html") % 3
    return page_images(spark, sf).withColumn(
        "blob", F.when(kind == 0, F.col("blob")).when(kind == 1, F.lit(b""))
    )


@query("carry_forward", CARRY_SQL)
def carry_forward(spark, sf):
    carried = images.carry_forward(sparse_images(spark, sf).drop("html"))
    return carried.select("bag_id", "seq", F.md5("blob").alias("digest"))


@query("carry_forward_split", CARRY_SQL)
def carry_forward_split(spark, sf):
    carried = images.carry_forward(sparse_images(spark, sf).drop("html"), target_rows=5)
    return carried.select("bag_id", "seq", F.md5("blob").alias("digest"))


ALIGN_IMAGES_SQL = (f"""{PAGES}, {CODECS.replace('FROM pages_blob', "FROM (SELECT bag_id, seq, encoding, CASE WHEN length(html) % 3 = 0 THEN hx END AS hx FROM pages_blob WHERE seq % 4 <> 0)")},
      m AS (SELECT bag_id, ts_ns, hx FROM pages_blob WHERE seq % 4 <> 0 AND length(html) % 3 = 0),
      a AS (SELECT c.bag_id, c.seq, coalesce(m.hx, '') AS hx FROM (SELECT * FROM pages_blob WHERE seq % 4 = 0) c
            ASOF LEFT JOIN m ON c.bag_id = m.bag_id AND c.ts_ns >= m.ts_ns)
    SELECT a.bag_id, a.seq, md5(unhex(hx)) AS digest, codec, {MEDIA} AS media_type FROM a LEFT JOIN codecs ON a.bag_id = codecs.bag_id""")


@query("align_images", ALIGN_IMAGES_SQL)
def align_images_query(spark, sf):
    """Every fourth page stands for a camera frame, the others for images: all are used."""
    rows = sparse_images(spark, sf)
    clock = rows.where("seq % 4 = 0").select("bag_id", "ts_ns", "seq")
    shots = rows.where("seq % 4 <> 0").select("bag_id", "ts_ns", "seq", "encoding", "blob")
    shown = align_images(clock, shots)
    return shown.select("bag_id", "seq", F.md5("blob").alias("digest"), "codec", "media_type")


@query("images_written", ALIGN_IMAGES_SQL)
def images_written(spark, sf):
    """The same images and media types, written by recording and read back."""
    rows = sparse_images(spark, sf)
    clock = rows.where("seq % 4 = 0").select("bag_id", "ts_ns", "seq")
    shown = align_images(clock, rows.where("seq % 4 <> 0").select("bag_id", "ts_ns", "seq", "encoding", "blob"))
    path = scratch_path(spark, "images")
    write_by_bag(shown, path)
    bag = F.col("bag_id").cast(rows.schema["bag_id"].dataType).alias("bag_id")
    return spark.read.parquet(path).select(bag, "seq", F.md5("blob").alias("digest"), "codec", "media_type")


FRAME_WIDTH = 61


@query(
    "tile_crop",
    f"""WITH b AS (SELECT page_id, hex(encode(html)) AS hx, greatest(2, (octet_length(encode(html)) + {FRAME_WIDTH} - 1) // {FRAME_WIDTH}) AS h FROM pages),
      f AS (SELECT page_id, rpad(hx, CAST(h * {FRAME_WIDTH} * 2 AS INT), '0') AS hx, {FRAME_WIDTH} AS w, h FROM b),
      t AS (SELECT page_id, hx, w, h, unnest(['left_eye', 'right_eye', 'left_wrist', 'right_wrist']) AS camera,
        unnest([0, 0, h // 2, h // 2]) AS r0, unnest([h // 2, h // 2, h, h]) AS r1,
        unnest([0, w // 2, 0, w // 2]) AS c0, unnest([w // 2, w, w // 2, w]) AS c1 FROM f)
    SELECT page_id, camera, (r1 - r0) * (c1 - c0) AS n_bytes,
      md5(unhex(array_to_string(list_transform(range(r0, r1), lambda r: substr(hx, (r * w + c0) * 2 + 1, (c1 - c0) * 2)), ''))) AS digest FROM t""",
)
def tile_crop(spark, sf):
    """Page bytes as one-channel frames of a fixed width and two rows at least, zeros after the last byte."""
    height = F.expr(f"greatest(2L, (octet_length(encode(html, 'UTF-8')) + {FRAME_WIDTH - 1}) DIV {FRAME_WIDTH})")
    frames = table(spark, sf, "pages").withColumn("height", height).select(
        "page_id",
        F.rpad(F.encode("html", "UTF-8"), F.col("height").cast("int") * FRAME_WIDTH, F.lit(b"\x00")).alias("pixels"),
        F.lit(FRAME_WIDTH).cast("bigint").alias("width"),
        "height",
        F.lit(1).cast("bigint").alias("channels"),
    )
    return images.tile_crop(frames).select(
        "page_id", "camera", F.octet_length("tile").cast("bigint").alias("n_bytes"), F.md5("tile").alias("digest")
    )


# --- documents as packet streams --------------------------------------------------------

PART = 50_000
PACKETS_SQL = f"""WITH p AS (SELECT source || '-' || lang AS stream, doc_id, text, octet_length(encode(text)) AS size FROM documents),
  s AS (SELECT *, CAST(sum(size) OVER (PARTITION BY stream ORDER BY doc_id) - size AS BIGINT) // {PART} AS part FROM p)
  SELECT stream, part, count(*) AS n_packets, CAST(sum(size) AS BIGINT) AS n_bytes, md5(string_agg(text, '' ORDER BY doc_id)) AS digest FROM s GROUP BY 1, 2"""


def packets(spark, sf, **options):
    rows = table(spark, sf, "documents").select(
        F.concat_ws("-", "source", "lang").alias("stream"), "doc_id", F.encode("text", "UTF-8").alias("packet")
    )
    parts = images.concat_packets(rows, order=("doc_id",), part_bytes=PART, **options)
    return parts.select(
        "stream", "part", "n_packets", F.octet_length("data").cast("bigint").alias("n_bytes"),
        F.md5("data").alias("digest"),
    )


@query("concat_packets", PACKETS_SQL)
def concat_packets(spark, sf):
    return packets(spark, sf)


@query("concat_packets_split", PACKETS_SQL)
def concat_packets_split(spark, sf):
    return packets(spark, sf, target_rows=20)


@query(
    "extract_numbers",
    r"""SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l)::DOUBLE AS number
        FROM (SELECT doc_id, regexp_extract_all(text, '[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?') AS l FROM documents)""",
)
def extract_numbers_query(spark, sf):
    numbers = table(spark, sf, "documents").select("doc_id", extract_numbers(F.col("text")).alias("n"))
    return numbers.select("doc_id", F.posexplode("n").alias("pos", "number")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


# --- conversations as episodes with tasks ------------------------------------------------


def turns(spark, sf):
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("segment_id"), "turn", F.col("text").alias("task"), "role"
    )


@query(
    "task_text",
    """SELECT conv_id AS segment_id, turn, coalesce(CASE WHEN role <> 'system' THEN text END, 'task') AS from_text,
       coalesce(CASE WHEN role <> 'system' THEN text END, 'task') AS from_bytes, 'stack the cups' AS fixed FROM conversations""",
)
def task_text_query(spark, sf):
    rows = turns(spark, sf).withColumn("text", F.when(F.col("role") != "system", F.col("task")))
    rows = rows.withColumn("bytes", F.encode("text", "UTF-8"))
    def task(name, **options):
        return task_text(F.col(name), rows.schema[name].dataType, **options)
    return rows.select(
        "segment_id", "turn", task("text").alias("from_text"), task("bytes").alias("from_bytes"),
        task("text", override="stack the cups").alias("fixed"),
    )


TASKS = """tasks AS (SELECT row_number() OVER (ORDER BY f) - 1 AS task_index, text AS task
  FROM (SELECT text, min((conv_id, turn)) AS f FROM conversations GROUP BY text))"""


@query("task_table", f"WITH {TASKS} SELECT * FROM tasks")
def task_table(spark, sf):
    return episodes.task_table(turns(spark, sf), order=("segment_id", "turn"))


@query(
    "task_join",
    f"WITH {TASKS} SELECT conv_id AS segment_id, turn, task_index FROM conversations JOIN tasks ON text = task",
)
def task_join(spark, sf):
    rows = turns(spark, sf)
    tasks = episodes.task_table(rows, order=("segment_id", "turn"))
    return episodes.task_join(rows, tasks).select("segment_id", "turn", "task_index")


@query(
    "episode_tasks",
    """SELECT conv_id AS segment_id, row_number() OVER (PARTITION BY conv_id ORDER BY f) - 1 AS position, role AS task
       FROM (SELECT conv_id, role, min(turn) AS f FROM conversations GROUP BY 1, 2)""",
)
def episode_tasks(spark, sf):
    rows = turns(spark, sf).withColumn("task", F.col("role"))
    return episodes.episode_tasks(rows, order=("turn",))
