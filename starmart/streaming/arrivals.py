"""Load raw monthly files as they arrive.

The file source remembers in its checkpoint which files it has seen, so a run handles new ones only. It
reads their names, not their content: the files of a micro-batch are landed and then loaded together,
each month by itself. A month that is refused is moved aside and written down with the reason, and the
others go on. Landing and loading leave out what they did before, so a micro-batch that is replayed
after a failure adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart.plans import jobs
from starmart.sources import landing, paths, publish
from starmart.sources.raw import RAW_FILE_GLOB, file_period, raw_file_name, raw_file_period
from starmart.sources.warehouse import Warehouse

# Fixed value: the layout of Spark's source of whole files.
FILES = "path string, modificationTime timestamp, length bigint, content binary"

ASIDE = "_refused"
LOADED, REFUSED, WAITING = "loaded", "refused", "waiting"
DELIVERY = "year int, month int, state string, reason string, change bigint"


def read_arriving(spark: SparkSession, incoming: str, files_per_batch: int | None = None) -> DataFrame:
    """Year and month of new files, or of folders that new parts came to. Their content is not read."""
    year, month = file_period()
    reader = spark.readStream.format("binaryFile").schema(FILES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(f"{incoming}/{RAW_FILE_GLOB}").select(year.alias("year"), month.alias("month"))


def _log_path(warehouse: Warehouse) -> str:
    return f"{warehouse.root}/_deliveries"


def deliveries(warehouse: Warehouse) -> DataFrame:
    """What became of each month's file, the latest state: ``year, month, state, reason``."""
    path = _log_path(warehouse)
    if not paths.exists(warehouse.spark, path):
        return warehouse.spark.createDataFrame([], DELIVERY).drop("change")
    latest = F.max_by(F.struct("state", "reason"), "change").alias("of")
    rows = warehouse.spark.read.schema(DELIVERY).parquet(path).groupBy("year", "month").agg(latest)
    return rows.select("year", "month", "of.*")


def _note(warehouse: Warehouse, states: dict[jobs.Period, tuple[str, str | None]]) -> None:
    if states:
        spark, change = warehouse.spark, publish.last_change(warehouse.spark, warehouse.root)
        noted = len(paths.names_in(spark, _log_path(warehouse)))
        rows = [(*p, *state, (change << 20) + noted) for p, state in sorted(states.items())]
        spark.createDataFrame(rows, DELIVERY).coalesce(1).write.mode("append").parquet(_log_path(warehouse))


def handle(job: jobs.MartJob, periods: set[jobs.Period]) -> jobs.Loaded:
    """Land and load the months' files that are there; puts refused ones aside and notes every outcome."""
    spark = job.spark
    found = {p: landing.state_of_delivery(spark, job.incoming, *p) for p in sorted(periods)}
    ready = {p for p, state in found.items() if state == "ready"}
    states: dict = {p: (WAITING, "parts are still arriving") for p, s in found.items() if s == "incomplete"}
    result = jobs.load_deliveries(job, ready) if ready else jobs.Loaded(0, set(), {})
    for period in ready:
        states[period] = (REFUSED, result.refused[period]) if period in result.refused else (LOADED, None)
    _note(job.warehouse, states)
    for year, month in result.refused:
        name = raw_file_name(year, month)
        number = len(paths.names_in(spark, f"{job.incoming}/{ASIDE}"))
        paths.move(spark, f"{job.incoming}/{name}", f"{job.incoming}/{ASIDE}/{number:06d}-{name}")
    return result


def _again(job: jobs.MartJob) -> set[jobs.Period]:
    """Months that were refused or not whole and whose file is there now: the source may not name them anew."""
    open_ = deliveries(job.warehouse).filter(F.col("state") != LOADED).select("year", "month").collect()
    there = {raw_file_period(name) for name in paths.names_in(job.spark, job.incoming)}
    return {(r.year, r.month) for r in open_} & there


def load_arriving(job: jobs.MartJob, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Load all files present that were not handled before, then stop.

    They are one batch unless ``files_per_batch`` is given. A folder of parts is loaded once it has the
    mark that it is whole; until then it waits.
    """
    again = _again(job)
    if again:
        handle(job, again)

    def load(batch: DataFrame, batch_id: int) -> None:
        names = batch.filter("month IS NOT NULL").distinct().collect()  # one row per file's month
        handle(job, {(r.year, r.month) for r in names})

    return (
        read_arriving(job.spark, job.incoming, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
