"""Run the daily batch as filings land, with Structured Streaming's file source.

Each micro-batch lists the new filing files (paths only: the ``binaryFile`` source is
pruned to its ``path`` column, so contents are not read here), derives the filing days
they belong to, and re-runs ``run_dates`` for exactly those days. ``run_dates`` rebuilds
a day from all of its landed files and overwrites the day, so replaying a micro-batch
after a failure gives the same tables (idempotent sink); the stream checkpoint records
which files were seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formlake import constants as K
from formlake.plans.daily_batch import run_dates
from formlake.sources.lake import table_path

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
DAY_IN_PATH = r"/(\d{4}-\d{2}-\d{2})/[^/]*$"


def start_filings_stream(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    fundamentals_raw: DataFrame | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    on_batch=None,
) -> StreamingQuery:
    """Start the stream. ``checkpoint`` is the lasting folder that records what was seen: a fresh one
    would rebuild every day. ``available_now`` processes everything landed so far and stops;
    otherwise it triggers every ``processing_time`` (e.g. '1 hour')."""
    folder = table_path(root, K.TABLE_FILINGS)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", K.FILING_FILES)
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    days = reader.load(folder).select(F.regexp_extract("path", DAY_IN_PATH, 1).alias("day"))

    def build_days(batch: DataFrame, epoch_id: int) -> None:
        # distinct days of one micro-batch: bounded by the calendar, not by the data
        touched = sorted(r["day"] for r in batch.filter(F.col("day") != "").distinct().collect())
        if touched:
            report = run_dates(spark, root, touched, fundamentals_raw)
            if on_batch is not None:
                on_batch(epoch_id, report)

    writer = days.writeStream.foreachBatch(build_days).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
