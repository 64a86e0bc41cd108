"""Large CSV files with quoted line breaks, read by many tasks.

A reader that starts in the middle of a file cannot know whether a line break ends a record or is
part of a quoted cell. The number of quotes before it tells: inside a quoted cell it is odd, as an
escaped quote is two. So one pass counts the quotes of every block of a file; the parity of all
blocks before it says how a block begins. In a second pass each block cuts its own lines into
records. What a block ends in the middle of is put together with the beginnings of the next ones,
one or two pieces a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.session import materialise, ship_with_tasks

ship_with_tasks(__name__)

QUOTE = '"'
_PIECES = "path string, file string, block long, opens boolean, first boolean, whole boolean, record string"
_BATCH = 2000


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, file, block, value): the lines in order; `block` is where their part of the file begins."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def quote_parity(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, block, before, after, returns): whether the number of quotes up to a block's begin and end
    is odd, and whether the block's first line ends in a carriage return.

    One row a block, however large the blocks.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counts = _lines(spark, paths).groupBy("path", "block").agg(
        F.sum(quotes).alias("quotes"), F.first(F.col("value").endswith("\r")).alias("returns"))
    upto = Window.partitionBy("path").orderBy("block")
    after = F.sum("quotes").over(upto)
    return counts.select(
        "path", "block", F.pmod(after - F.col("quotes"), F.lit(2)).cast("boolean").alias("before"),
        F.pmod(after, F.lit(2)).cast("boolean").alias("after"), "returns")


def _cutter(inside):
    """Cuts the lines of each block into records and pieces of records."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, returning = inside.value
        out: list[tuple] = []
        here, held, quoted, opens, first = None, [], False, True, False

        def close(whole: bool) -> None:
            nonlocal held, opens, first
            if held:
                out.append((*here, opens, first, whole and opens, "\n".join(held)))
                held, opens, first = [], True, False

        for batch in batches:
            for path, file, block, line in zip(*(batch.column(c).to_pylist() for c in ("path", "file", "block", "value"))):
                if here != (path, file, block):
                    close(False)
                    here = path, file, block
                    quoted, first = (path, block) in odd, block == 0
                    opens = not quoted  # else the block begins inside a record
                    line = line.removeprefix("\ufeff") if first else line
                held.append(line.removesuffix("\r") if path in returning else line)
                quoted ^= line.count(QUOTE) % 2 == 1
                if not quoted:
                    close(True)
                if len(out) >= _BATCH:
                    yield _batch(out)
                    out = []
        close(False)
        yield _batch(out)

    return cut


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def read_records(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """((file, first, record) of all files, files whose quotes are not balanced).

    `first` marks a file's header. Files named in the second value are left out: a quote in them
    is not paired, so only a reader that begins at the beginning can tell their records. The
    blocks that begin inside a record are what travels to the tasks, some bytes for each block.
    """
    parity = materialise(quote_parity(spark, paths), "quote-parity")
    ends = parity.groupBy("path").agg(F.max_by("after", "block").alias("odd"))
    broken = sorted(r.path for r in ends.filter("odd").collect())
    # a file's first line tells how its lines end; within cells too that is a line feed then
    inside = spark.sparkContext.broadcast((
        {(r.path, r.block) for r in parity.filter("before").collect()},
        {r.path for r in parity.filter("block = 0 AND returns").collect()}))
    lines = _lines(spark, paths)
    if broken:
        lines = lines.filter(~F.col("path").isin(broken))
    pieces = lines.mapInArrow(_cutter(inside), _PIECES)
    whole = pieces.filter("whole").select("file", "first", "record")
    # a piece that opens a record begins a new number, those after it belong to it
    order = Window.partitionBy("path").orderBy("block", "opens")
    numbered = pieces.filter("NOT whole").withColumn("number", F.sum(F.col("opens").cast("long")).over(order))
    joined = numbered.groupBy("path", "file", "number").agg(
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))
    return whole.unionByName(joined.select(
        "file", "first", F.array_join(F.col("parts.record"), "\n").alias("record"))), broken


def parse(records: DataFrame, names: list[str], options: dict[str, str]) -> DataFrame:
    """(file, *names): the cells of the records that are no header and not empty."""
    rows = records.filter(~F.col("first") & (F.col("record") != ""))
    schema = ", ".join(f"`{n}` string" for n in names)
    cells = F.from_csv("record", F.lit(schema), {**options, "multiLine": "true", "mode": "PERMISSIVE"})
    return rows.select("file", cells.alias("cells")).select("file", "cells.*")
