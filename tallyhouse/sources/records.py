"""Records of CSV files whose quoted fields may hold line breaks, read in parallel.

A line break ends a record only outside quotes, and whether a line begins inside
quotes depends on all quotes before it. Files are still read in blocks: a first pass
counts the quotes of every chunk of a block, a running sum over the chunks of a file
tells in which state each begins. Chunks that begin outside quotes and whose lines all
hold an even number of them, in most files all, then give a record per line without
a shuffle. Only the lines of the other chunks are put in order, in as many tasks as
their lines need, and only the lines of records that span lines are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.context import scratch_table
from tallyhouse.sources.errors import LoadError


# lines of a block that are put in order together
CHUNK_LINES = 1 << 17
# lines and bytes that a task puts in order, about
LINES_PER_TASK = 500_000
BYTES_PER_TASK = 64 * 1024 * 1024
# chunks of blocks listed by the driver and sent to every task; a row is a file name and a few numbers
MOST_LISTED = 100_000
# a quoted field that swallows whole blocks up to this many bytes is taken for an unpaired quote
LONGEST_RECORD = 256 * 1024 * 1024


CHUNK = ["file_path", "file_block_start", "chunk"]


def _quotes(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """Every line with its block, its place, its quotes, and whether it spells the header."""
    at = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start", "file_block_length")]
    text = spark.read.option("lineSep", "\n").text(path)
    spelled = ",".join(header)
    # quotes around every name, a byte order mark and a carriage return may be there; most lines differ in length alone
    size = F.octet_length("value").between(len(spelled), len(spelled) + 2 * len(header) + 4)
    is_header = (F.col("_metadata.file_block_start") == 0) & size & (F.translate("value", '"\r﻿', "") == spelled)
    marks = [_quotes(F.col("value")).alias("quotes"), is_header.alias("is_header")]
    lines = text.select(*at, F.monotonically_increasing_id().alias("place"), "value", *marks)
    # a task's places begin at a multiple of every power of two, so a chunk is within one task
    return lines.withColumn("chunk", F.shiftright("place", CHUNK_LINES.bit_length() - 1))


def chunk_states(lines: DataFrame, header: list[str]) -> DataFrame:
    """Each chunk of each file: how it begins, whether its lines need putting together, what is wrong."""
    first = F.min_by("is_header", "place")
    chunks = lines.groupBy("file_path", "file_block_start", "file_block_length", "chunk").agg(
        F.sum("quotes").alias("quotes"),
        F.count_if(F.col("quotes") % 2 == 1).alias("turns"),
        first.alias("headed"),
        F.count_if("is_header").alias("headers"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.min("place").alias("low"),
        F.max("place").alias("high"),
    )
    file, block = Window.partitionBy("file_path"), Window.partitionBy("file_path", "file_block_start")
    earlier = file.orderBy("file_block_start", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    swallowed = F.col("inside") & (F.col("turns") == 0)
    opener = F.last(F.when(~swallowed, F.struct("file_block_start", "chunk")), ignorenulls=True).over(earlier)
    states = chunks.withColumn("inside", inside).withColumn("opener", opener)
    opens_block = F.col("chunk") == F.min("chunk").over(block)
    whole = swallowed & opens_block & (F.sum("turns").over(block) == 0)
    states = states.withColumn("opens_file", (F.col("file_block_start") == 0) & opens_block).withColumn("whole", whole)
    run = Window.partitionBy("file_path", F.when(swallowed, F.col("opener")))
    problem = (
        F.when(F.sum("quotes").over(file) % 2 == 1, "a quoted field is never closed")
        .when(F.col("opens_file") & ~F.col("headed"), f"the first line is not {','.join(header)}")
        .when(swallowed & (F.sum(F.when(F.col("whole"), F.col("file_block_length"))).over(run) > LONGEST_RECORD), "a quoted field is too long")
    )
    mixed = F.col("inside") | (F.col("turns") > 0) | (F.col("headers") > F.col("opens_file").cast("int"))
    known = F.col("file_block_length").alias("known_length")
    kept = ["inside", "opener", "opens_file", "lines", "bytes", "low", "high"]
    return states.select(*CHUNK, known, *kept, mixed.alias("mixed"), problem.alias("problem"))


def _only(lines: DataFrame, condition: Column) -> DataFrame:
    """The values of some lines.

    The condition is part of the value, as what a caller says of a record, or raises for
    one, must never be asked of a line the condition leaves out.
    """
    return lines.select(F.when(condition, F.col("value")).alias("value")).where(F.col("value").isNotNull())


def _by(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Rows of equal keys together, in as many tasks as their number needs, if those are more than the session's."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys) if tasks > usual else df


def _put_together(lines: DataFrame, tasks: int) -> DataFrame:
    """Records of the chunks that need their lines in order; ``lines`` carry the states of their chunks."""
    chunk = Window.partitionBy(*CHUNK)
    order = chunk.orderBy("place")
    earlier, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    outside = (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) + F.col("inside").cast("int")) % 2 == 0
    lines = _by(lines, tasks, *CHUNK).withColumn("opens", outside).withColumn("nth", F.row_number().over(order))
    opened = F.when(F.col("opens"), F.col("nth"))
    lines = lines.withColumn("record", F.last(opened, ignorenulls=True).over(so_far)).withColumn("last", F.max(opened).over(chunk))
    lines = lines.where(~(F.col("opens_file") & (F.col("nth") == 1)))
    alone = F.col("opens") & (F.col("quotes") % 2 == 0)
    # the last record a chunk opens may go on in the next chunk, where no line opens it
    carried = F.col("record").isNull()
    home = F.when(carried, F.col("opener")).otherwise(F.struct("file_block_start", "chunk"))
    number = F.when(carried | (F.col("record") == F.col("last")), -1).otherwise(F.col("record"))
    parts = F.sort_array(F.collect_list(F.struct("file_block_start", "place", "value")))
    spanning = lines.where(~alone).select("file_path", home.alias("home"), number.alias("number"), "file_block_start", "place", "value")
    spanning = (
        _by(spanning, tasks, "file_path", "home", "number")
        .groupBy("file_path", "home", "number")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    )
    return _only(lines, alone).unionByName(spanning.select("value"))


def csv_records(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """One row per record (column ``value``), without the header every file begins with.

    Blank records are left out. Raises ``LoadError`` for a file with another header,
    or a quote that is never closed.
    """
    lines = _lines(spark, path, header)
    states = scratch_table(chunk_states(lines, header), "chunks")
    # the chunks with problems first, then those that need more than their lines
    listed = states.orderBy(F.col("problem").desc_nulls_last(), F.col("mixed").desc()).limit(MOST_LISTED + 1).collect()
    if listed and listed[0]["problem"]:
        raise LoadError(f"{listed[0]['file_path']}: {listed[0]['problem']}")
    if not listed or not listed[0]["mixed"]:
        # no line of any file leaves a quote open, so it does not matter where chunks begin
        records = _only(lines, ~F.col("is_header"))
    else:
        need = states.where("mixed").agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes")).first()
        tasks = max(-(-need["lines"] // LINES_PER_TASK), -(-need["bytes"] // BYTES_PER_TASK))
        # beyond the limit chunks are joined as their number allows
        known = F.broadcast(spark.createDataFrame(listed, states.schema)) if len(listed) <= MOST_LISTED else states
        marked = lines.join(known.drop("problem", "lines", "bytes"), CHUNK, "left")
        there = (F.col("known_length") == F.col("file_block_length")) & F.col("place").between(F.col("low"), F.col("high"))
        same = F.coalesce(there, F.lit(False))
        moved = F.raise_error(F.lit("the blocks of the files changed between two passes; run again"))
        marked = marked.where(F.when(same, F.lit(True)).otherwise(moved.cast("boolean"))).drop("low", "high")
        plain = _only(marked, ~F.col("mixed") & ~F.col("is_header"))
        records = plain.unionByName(_put_together(marked.where("mixed"), tasks))
    ended = F.when(F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return records.select(ended.alias("value")).where(F.trim("value") != "")
