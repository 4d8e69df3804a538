"""Files filled one after the other: an episode opens a new file where it would fill the current one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from robolog.operators.episodes import FILES_PER_CHUNK
from robolog.operators.scan import last_value, next_value, numbered, scan
from robolog.session import materialize


def next_starts(rows: DataFrame, target: int, target_rows: int | None = None) -> DataFrame:
    """For every row as the first of a file, the first of the next: (_n, _next), without rows that have none.

    ``rows`` has _n, _before (bytes of all rows before) and _size. The next file starts at the first later
    row whose end is ``target`` or more past this row's begin. Ends and searched values are put in one
    order, where the answer is the next end, so no row is compared with more than its neighbour.
    """
    ends = rows.select(F.lit(0).alias("_k"), (F.col("_before") + F.col("_size")).alias("_at"), F.lit(1).alias("_is_end"), "_n", F.col("_n").alias("_end"))
    sought = rows.select(F.lit(0).alias("_k"), (F.col("_before") + F.lit(target)).alias("_at"), F.lit(0).alias("_is_end"), "_n", F.lit(None).cast("bigint").alias("_end"))
    found = scan(ends.unionByName(sought), ["_k"], ["_at", "_is_end", "_n"], target_rows=target_rows, _found=next_value("_end"))
    # A row that fills a file by itself ends past the target too, but the next file is that of the row after it.
    following = found.where("_is_end = 0").select("_n", F.greatest(F.col("_n") + 1, F.col("_found")).alias("_next"))
    return following.where("_found IS NOT NULL").join(rows.select(F.col("_n").alias("_next")), "_next", "left_semi").select("_n", "_next")


def reached(jumps: DataFrame, start: DataFrame) -> DataFrame:
    """All rows that the jumps reach from ``start`` (_n), in as many rounds as their number has binary digits.

    A round adds what lies as many jumps ahead as are known, and doubles the length of each jump.
    """
    known, jumps = materialize(start), materialize(jumps)
    while True:
        ahead = known.join(jumps, "_n").select(F.col("_next").alias("_n"))
        more = materialize(known.unionByName(ahead))
        if more.count() == known.count():
            return known
        further = jumps.select(F.col("_n").alias("_next"), F.col("_next").alias("_last"))
        known, jumps = more, materialize(jumps.join(further, "_next").select("_n", F.col("_last").alias("_next")))


def pack_files(
    episodes: DataFrame,
    *,
    target_bytes: int,
    order: str = "episode_index",
    size: str = "size_bytes",
    files_per_chunk: int = FILES_PER_CHUNK,
    first_file: int = 0,
    filled: int = 0,
    target_rows: int | None = None,
) -> DataFrame:
    """Add chunk_index and file_index by next fit: an episode goes into the current file unless the file's bytes
    with its own reach ``target_bytes``; then it opens the next file. A file has at least one episode.

    ``first_file`` and ``filled`` name the file that earlier episodes have begun and its bytes. Sizes are
    whole and not negative; a missing size counts as 0. The sequential rule is answered without a loop over
    episodes: each one's next file start is searched in the running sums, and the starts that follow from
    the first are found by pointer doubling.
    """
    sized = episodes.withColumn("_size", F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)))
    placed = materialize(numbered(sized, order, "_n", _before="_size"))
    rows = placed.select("_n", F.col("_before").cast("bigint").alias("_before"), "_size")
    if filled:
        begun = placed.sparkSession.createDataFrame([(0, 0, filled)], "_n bigint, _before bigint, _size bigint")
        rows = begun.unionAll(rows.select(F.col("_n") + 1, F.col("_before") + filled, "_size"))
    first = rows.where("_n = 0").select("_n")
    starts = numbered(reached(next_starts(rows, target_bytes, target_rows), first), "_n", "_file")
    marked = placed.withColumn("_n", F.col("_n") + (1 if filled else 0)).join(starts, "_n", "left").withColumn("_k", F.lit(0))
    filed = scan(marked, ["_k"], ["_n"], target_rows=target_rows, _in=last_value("_file"))
    # Episodes before the first start are in the file that had been begun.
    file = F.coalesce(F.col("_in"), F.lit(0)) + first_file
    return (
        filed.withColumn("_in", file)
        .withColumn("chunk_index", F.expr(f"_in DIV {files_per_chunk}"))
        .withColumn("file_index", F.expr(f"_in % {files_per_chunk}"))
        .drop("_k", "_n", "_size", "_before", "_file", "_in")
    )
