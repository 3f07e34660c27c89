"""Report files in the landing zone.

Zones under one root, each report a CSV file or a folder of CSV part files:

    daily-files/{date}/{fund}/{date}-{fund}-{report}.csv
    backfill-files/{from}_{to}/{fund}/{from}_{to}-{fund}-{report}.csv
    history-files/{any}/{any text with the report name}.csv
"""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfolio.operators.cleaning import CLEANERS
from tallyfolio.operators.filters import union_all
from tallyfolio.operators.merge import latest_per_key, survivors
from tallyfolio.schemas import CORE_TABLES, REPORT_COLUMNS

# Where a row came from: when its file was written, and which one it was.
ORIGIN = ["file_time", "file_path"]
# The same as one number, by ``file_places``.
PLACE = "file_place"

# Level 4 of gzip takes less than half the time of its default for a tenth more bytes. Such files are not split over
# tasks, so they are kept short.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "FOUR", "maxRecordsPerFile": 500_000}


@dataclass(frozen=True)
class Landing:
    """Paths of the landing zone under ``root``."""

    root: str

    def daily(self, day: dt.date, fund: str, report: str) -> str:
        return f"{self.root}/daily-files/{day}/{fund}/{day}-{fund}-{report}.csv"

    def backfill(self, start: dt.date, end: dt.date, fund: str, report: str) -> str:
        span = f"{start}_{end}"
        return f"{self.root}/backfill-files/{span}/{fund}/{span}-{fund}-{report}.csv"

    def daily_glob(self, day: dt.date, report: str) -> str:
        return f"{self.root}/daily-files/{day}/*/*-{report}.csv"

    def backfill_glob(self, start: dt.date, end: dt.date, report: str) -> str:
        return f"{self.root}/backfill-files/{start}_{end}/*/*-{report}.csv"

    def zone_globs(self, report: str) -> list[str]:
        """Every file of a report: history, backfill, daily."""
        return [
            f"{self.root}/history-files/*/*{report}*.csv",
            f"{self.root}/backfill-files/*/*/*{report}.csv",
            f"{self.root}/daily-files/*/*/*{report}.csv",
        ]


# Doubled quotes, as spreadsheets and most CSV writers have them; Spark's own default is a backslash.
CSV_OPTIONS = {"escape": '"', "quote": '"'}


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], with_origin: bool = False, multi_line: bool = False
) -> DataFrame:
    """All columns as text under the header's names; no inference pass. ``with_origin`` adds the
    ``ORIGIN`` columns.

    Text keeps leading zeros of identifiers. Columns are named by the first file's header, and a
    file with another header fails the read instead of being read by position. ``multi_line`` allows
    line breaks in quoted text; such files are not split over tasks.
    """
    rows = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(paths)
    )
    return rows.select("*", *_origin()) if with_origin else rows


def _origin() -> list[Column]:
    return [
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
    ]


HEADER_BYTES = 1 << 16
HEADER_THREADS = 32


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[str, int]]:
    """(path, bytes) of the files under globs, part files of folders included; names with ``_`` or ``.`` in front
    are not data. Paths are as ``_metadata.file_path`` has them, by ``plain_path``."""
    jvm, conf, found = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for glob in [paths] if isinstance(paths, str) else paths:
        pattern = jvm.org.apache.hadoop.fs.Path(glob)
        store = pattern.getFileSystem(conf)
        queue = list(store.globStatus(pattern) or [])
        while queue:
            status = queue.pop()
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                queue += list(store.listStatus(status.getPath()))
            else:
                found.append((status.getPath().toUri().toString(), status.getLen()))
    return sorted(set(found))


def plain_path(path: Column) -> Column:
    """A file's URI with one slash after a scheme that has no host; writers differ in that."""
    return F.regexp_replace(path, "^([^:/]+):///", "$1:/")


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, of which no more than its first bytes are read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    stream = place.getFileSystem(conf).open(place)
    try:
        if codec := jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place):
            stream = codec.createInputStream(stream)
        taken = b""
        while b"\n" not in taken and (more := bytes(stream.readNBytes(HEADER_BYTES))):
            taken += more
    finally:
        stream.close()
    return taken.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8-sig")


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, str]:
    """The first line of each file that has one, by its path. The driver lists the files, as any scan makes it do,
    and reads the first bytes of each, many at a time; no content is scanned."""
    files = [path for path, size in list_files(spark, paths) if size]
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        return dict(zip(files, pool.map(lambda path: _first_line(spark, path), files), strict=True))


def read_csv_by_layout(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], with_origin: bool = False
) -> DataFrame:
    """``columns`` of files that may differ in columns or their order, each read by its own first line.

    A file whose header lacks one of the columns is an error that names it. With one header for all, the files
    are read as they are. Else there is one scan of lines, whatever the number of layouts: a table of (file, layout)
    tells each line which positions hold the columns. Lines are parsed by their layout's number of columns, so
    one with more or fewer fails.
    """
    headers = file_headers(spark, paths)
    if not headers:
        raise ValueError(f"no lines under {paths}")
    layouts = sorted(set(headers.values()))
    names = [next(csv.reader([header]), []) for header in layouts]
    for path, header in headers.items():
        lacking = [c for c in columns if c not in names[layouts.index(header)]]
        if lacking:
            raise ValueError(f"{path} has no column {', '.join(lacking)} in its header")
    origin = ORIGIN if with_origin else []
    if len(layouts) == 1:
        return read_csv(spark, paths, with_origin).select(*[F.col(f"`{c}`") for c in columns], *origin)
    place = {header: i for i, header in enumerate(layouts)}
    files = spark.createDataFrame([(path, place[header]) for path, header in headers.items()], "file string, layout int")
    lines = spark.read.text(paths).select("value", *_origin())
    keyed = lines.withColumn("file", plain_path(F.col("file_path"))).join(files.withColumn("file", plain_path(F.col("file"))), "file")
    layout, value = F.col("layout"), F.rtrim("value")
    header = F.element_at(F.array(*map(F.lit, layouts)), layout + 1)
    content = (value != "") & (value != F.rtrim(header))
    # one parse per number of columns; the test is inside the expression too, as filters may be put in any order
    parsed = F.lit(None).cast("array<string>")
    for width in sorted({len(n) for n in names}):
        own = layout.isin([i for i, n in enumerate(names) if len(n) == width])
        fields = F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(width)), {**CSV_OPTIONS, "mode": "FAILFAST"})
        # a struct's fields are taken from one parse, an array of them would parse once for each
        parsed = F.when(content & own, F.transform(F.array(fields), _cells(width))[0]).otherwise(parsed)
    rows = keyed.filter(content).select(parsed.alias("cells"), "layout", *ORIGIN)
    picked = []
    for c in columns:
        positions = F.element_at(F.array(*[F.lit(n.index(c)) for n in names]), layout + 1)
        picked.append(F.element_at("cells", positions + 1).alias(c))
    return rows.select(*picked, *origin)


def _cells(width: int) -> Callable[[Column], Column]:
    return lambda row: F.array(*[row[f"c{i}"] for i in range(width)])


def read_report(
    spark: SparkSession,
    paths: str | Sequence[str],
    report: str,
    mixed_layouts: bool = True,
    with_origin: bool = False,
) -> DataFrame:
    """Cleaned rows of one report from any number of files. ``mixed_layouts=False`` skips the look at
    the headers and refuses files that differ in them."""
    if mixed_layouts:
        rows = read_csv_by_layout(spark, paths, list(REPORT_COLUMNS[report]), with_origin)
    else:
        rows = read_csv(spark, paths, with_origin)
    return CLEANERS[report](rows, keep=ORIGIN if with_origin else ())


def read_daily(spark: SparkSession, landing: Landing, day: dt.date, report: str, **options) -> DataFrame:
    return read_report(spark, landing.daily_glob(day, report), report, **options)


def read_backfill(
    spark: SparkSession, landing: Landing, start: dt.date, end: dt.date, report: str, **options
) -> DataFrame:
    return read_report(spark, landing.backfill_glob(start, end, report), report, **options)


def read_all_zones(
    spark: SparkSession,
    landing: Landing,
    report: str,
    newest_only: bool = False,
    mixed_layouts: bool = True,
    by_field: bool = False,
) -> DataFrame:
    """Reload: every zone that has files, in one scan, repeated rows removed.

    A key whose values differ between files stays repeated, and a merge will refuse it. With
    ``newest_only`` the file written last decides, as it would had the files been loaded in turn. With
    ``by_field`` it does so for each column by itself, and an empty value leaves an older one standing.
    """
    globs = [glob for glob in landing.zone_globs(report) if has_files(spark, glob)]
    if not globs:
        raise ValueError(f"no {report} files under {landing.root}")
    rows = read_report(spark, globs, report, mixed_layouts, with_origin=newest_only or by_field)
    if by_field:
        # a row moves with a number for its file, not with the path beside each column
        placed = rows.join(F.broadcast(file_places(spark, globs)), "file_path").drop(*ORIGIN)
        return survivors(placed, CORE_TABLES[report].key, [PLACE]).select(*CORE_TABLES[report].columns)
    if newest_only:
        return latest_per_key(rows, CORE_TABLES[report].key, ORIGIN).drop(*ORIGIN)
    return rows.distinct()


def file_places(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file_path, file_place): the files numbered in the order of ``ORIGIN``. They are listed, not read."""
    listed = spark.read.format("binaryFile").load(paths).select(*_origin()).distinct()
    found = listed.select(F.unix_micros("file_time"), "file_path").collect()
    numbered = [(path, i) for i, (_, path) in enumerate(sorted(map(tuple, found)))]
    return spark.createDataFrame(numbered, f"file_path string, {PLACE} int")


def has_files(spark: SparkSession, glob: str) -> bool:
    """Whether a glob matches anything; reads no content."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return not listed.load(glob).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def list_source_files(spark: SparkSession, root: str) -> DataFrame:
    """CSV files under ``root`` at any depth, with sizes; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{csv,csv.gz}")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("length").alias("n_bytes"))
    )


def land_report(df: DataFrame, path: str, compressed: bool = False) -> None:
    """Write one report as CSV under its landing path, in place of an earlier one; ``compressed`` with gzip."""
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS).option("header", True)
    if compressed:
        writer = writer.options(**COMPRESSED)
    writer.csv(path)


def land_partitioned(df: DataFrame, root: str, run_date: str = "run_date", fund: str = "fund") -> None:
    """Write the reports of many days and funds in one job, replacing only the folders it fills.

    Rows are rebalanced by folder first: a task writes few files, and a folder that holds much
    of the data is split over several tasks.
    """
    (
        df.hint("rebalance", F.col(run_date), F.col(fund))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**CSV_OPTIONS)
        .option("header", True)
        .partitionBy(run_date, fund)
        .csv(root)
    )


def union_partials(frames: Sequence[DataFrame]) -> DataFrame:
    """Partial extracts of one report as one frame, matched by column name."""
    return union_all(frames)
