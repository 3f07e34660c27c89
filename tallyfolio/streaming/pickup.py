"""Daily report files as a stream: each run takes the files that are new since the last one.

The merge is by primary key and the checkpoint records which files were taken, so a run that dies
and is repeated changes nothing twice; a corrected file that lands later replaces its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyfolio.operators.cleaning import CLEANERS
from tallyfolio.schemas import REPORT_COLUMNS
from tallyfolio.sources.reports import CSV_OPTIONS, ORIGIN, Landing
from tallyfolio.sources.tables import Warehouse


def pick_up(
    warehouse: Warehouse,
    landing: Landing,
    report: str,
    columns: Sequence[str] | None = None,
    *,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Merge all new daily files of a report, then stop; wait with ``awaitTermination()``.

    ``columns`` is the files' header in its order, by default the report's known columns. A file
    with another header fails the run. ``checkpoint`` is a folder that outlives the run. ``max_files`` splits a backlog into batches of that size.
    """
    header = list(columns or REPORT_COLUMNS[report])
    reader = (
        warehouse.spark.readStream.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
        .options(**CSV_OPTIONS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.csv(f"{landing.root}/daily-files/*/*/*-{report}.csv")
    files = files.select(
        "*", F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path").alias("file_path")
    )
    rows = CLEANERS[report](files, keep=ORIGIN)

    def merge(batch: DataFrame, _: int) -> None:
        warehouse.merge(report, batch, on_duplicate="latest", order=ORIGIN)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
