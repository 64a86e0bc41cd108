"""Reading, consolidating, repairing and writing ticket files."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.constants import CELL_REPAIRS, NA_TOKENS, RAW_COLUMNS, SOURCE_COLUMN
from ticketloom.session import materialise
from ticketloom.sources.headers import canonical_columns
from ticketloom.sources.split_csv import parse, read_records
from ticketloom.sources.workbook import read_workbook_rows

CSV_OPTIONS = {"quote": '"', "escape": '"', "encoding": "UTF-8"}
_EXTRA = "_extra"
# A quoted file up to this size is one task.
SPLIT_BYTES = 64 * 1024 * 1024


def missing_as_null(cell):
    """A cell that stands for a missing value is null."""
    return F.when(~cell.isin(NA_TOKENS), cell)


def csv_headers(spark: SparkSession, path: str) -> list[str]:
    """The raw header row of one file, duplicates kept. Reads the first record only."""
    first = spark.read.options(**CSV_OPTIONS, header=False, multiLine=True).csv(path).head()
    if first is None:
        raise ValueError("empty file")
    return ["" if v is None else v for v in first]


def read_csv(
    spark: SparkSession, paths: list[str], headers: list[str], multi_line: bool = True
) -> DataFrame:
    """All-string scan of files that share one header row.

    Columns are `_c0.._cN`, plus the file name and `_extra`, which is not null
    where a row has more cells than the header. `multi_line` allows quoted line
    breaks: a file beyond SPLIT_BYTES is then cut into blocks at records
    (split_csv.py), a smaller one, or one whose quotes are not paired, is one task.
    """
    names = [*(f"_c{i}" for i in range(len(headers))), _EXTRA]
    parts, whole = [], paths
    if multi_line:
        whole, large = _by_size(spark, paths)
        if large:
            records, unpaired = read_records(spark, large)
            parts.append(parse(records, names, CSV_OPTIONS).withColumnRenamed("file", SOURCE_COLUMN))
            whole = whole + unpaired
    if whole:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        options = {**CSV_OPTIONS, "header": True, "multiLine": multi_line, "enforceSchema": True}
        raw = spark.read.options(**options).schema(schema).csv(whole)
        parts.append(raw.select(F.col("_metadata.file_name").alias(SOURCE_COLUMN), *names))
    raw = reduce(DataFrame.unionByName, parts)
    return raw.select(*[missing_as_null(F.col(n)).alias(n) for n in names[:-1]], SOURCE_COLUMN, _EXTRA)


def _by_size(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """Files of up to SPLIT_BYTES, and larger ones; folders stand for their files."""
    small, large = [], []
    for path in paths:
        for status in _status(spark, path):
            name = status.getPath().getName()
            if status.isFile() and not name.startswith(("_", ".")):
                (large if status.getLen() > SPLIT_BYTES else small).append(status.getPath().toString())
    # what is not there is left to the reader, which says so
    return (small if small or large else list(paths)), large


def read_tickets(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One ticket file under its own headers; a missing file is an error."""
    headers = csv_headers(spark, path)
    return read_csv(spark, [path], headers, multi_line).drop(SOURCE_COLUMN, _EXTRA).toDF(*headers)


def read_tickets_or_workbook(spark: SparkSession, path: str, workbook: str) -> DataFrame:
    """The CSV if it exists, else the workbook."""
    if _status(spark, path):
        return read_tickets(spark, path)
    layouts, _ = _workbook_layouts(spark, [workbook], required=False)
    headers, rows = layouts[0]
    return rows.drop(SOURCE_COLUMN).toDF(*headers)


def _status(spark: SparkSession, path: str) -> list:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    return list(fs.listStatus(target)) if fs.exists(target) else []


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Files of `folder` with `suffix`, in name order. No data is read."""
    paths = [s.getPath().toString() for s in _status(spark, folder) if s.isFile()]
    return sorted(p for p in paths if p.endswith(suffix))


def discover(spark: SparkSession, folder: str) -> list[str]:
    """The CSV files of `folder` if there are any, else its workbooks."""
    return list_files(spark, folder, ".csv") or list_files(spark, folder, ".xlsx")


def _csv_layouts(
    spark: SparkSession, files: list[str], multi_line: bool
) -> tuple[list[tuple[list[str], DataFrame]], list[tuple[str, str]]]:
    def header(path: str):
        try:
            return csv_headers(spark, path), None
        except (PySparkException, ValueError) as error:
            return None, str(error).split("\n")[0]

    with ThreadPool(16) as pool:  # one tiny job a file: the first record
        found = pool.map(header, files)
    rejected = [(p.rsplit("/", 1)[-1], e) for p, (h, e) in zip(files, found) if h is None]
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, (headers, _) in zip(files, found):
        if headers is not None:
            layouts.setdefault(tuple(headers), []).append(path)
    return [
        (list(h), read_csv(spark, paths, list(h), multi_line)) for h, paths in layouts.items()
    ], rejected


def _workbook_layouts(spark: SparkSession, files: list[str], required: bool = True):
    rows = materialise(read_workbook_rows(spark, files, required=required), "workbooks")
    errors = [(r.file, r.error) for r in rows.filter(F.col("error").isNotNull()).collect()]
    failed = [name for name, _ in errors]
    layouts: dict[tuple[str, ...], list[str]] = {}
    for row in rows.filter("row = 0").collect():  # header rows, one per file
        if row.file not in failed:
            layouts.setdefault(tuple(c or "" for c in row.cells), []).append(row.file)
    parts = []
    for headers, names in layouts.items():
        cells = [
            missing_as_null(F.get("cells", F.lit(i))).alias(f"_c{i}") for i in range(len(headers))
        ]
        body = rows.filter((F.col("row") > 0) & F.col("file").isin(names))
        parts.append((list(headers), body.select(*cells, F.col("file").alias(SOURCE_COLUMN))))
    return parts, errors


def consolidate(
    spark: SparkSession, folder: str, check_rows: bool = True, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(tickets, rejected files) of a folder."""
    return consolidate_files(spark, discover(spark, folder), check_rows, multi_line)


def consolidate_files(
    spark: SparkSession, files: list[str], check_rows: bool = True, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """All readable files in the canonical columns plus the file name; the rest is reported.

    Each file is read by its own kind, so CSV files and workbooks may be mixed. Files with the same header row are one scan, so the plan grows with the
    number of layouts, not of files. A CSV file with a row that has too many
    cells is rejected as a whole; `check_rows` looks for those.
    """
    books = [f for f in files if f.endswith(".xlsx")]
    layouts, rejected = _csv_layouts(spark, [f for f in files if f not in set(books)], multi_line)
    if books:
        more, failed = _workbook_layouts(spark, books)
        layouts, rejected = layouts + more, rejected + failed
    reports = [spark.createDataFrame(rejected, "file string, reason string")]
    parts = []
    for headers, rows in layouts:
        if _EXTRA in rows.columns:
            if check_rows:
                ragged = (
                    rows.filter(F.col(_EXTRA).isNotNull())
                    .groupBy(F.col(SOURCE_COLUMN).alias("file"))
                    .agg(F.lit("a row has more cells than the header").alias("reason"))
                )
                bad = [r.file for r in ragged.collect()]  # file names only
                reports.append(
                    spark.createDataFrame(
                        [(f, "a row has more cells than the header") for f in bad],
                        "file string, reason string",
                    )
                )
                if bad:
                    rows = rows.filter(~F.col(SOURCE_COLUMN).isin(bad))
            rows = rows.drop(_EXTRA)
        parts.append(canonical_columns(rows, headers, SOURCE_COLUMN))
    empty = T.StructType(
        [T.StructField(c, T.StringType()) for c in [*RAW_COLUMNS, SOURCE_COLUMN]]
    )
    tickets = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], empty)
    return tickets, reduce(DataFrame.unionByName, reports)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Stack tables whose columns differ; absent cells are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def rows_per_source(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy(SOURCE_COLUMN).agg(F.count("*").alias("n"))


def repair_cells(df: DataFrame) -> DataFrame:
    """Replace whole cells that carry an old team code, in every column."""
    return df.replace(CELL_REPAIRS)


def write_csv(df: DataFrame, path: str) -> None:
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, escape='"', emptyValue="", **options).csv(path)
