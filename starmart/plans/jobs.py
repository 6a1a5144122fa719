"""Load jobs: set up the warehouse, land periods, load them, go on to the next, restate one.

A load stages its rows, then those of them that are new, then their keys, and checks all of it. Only
then do the staged files move into their tables, by a written plan that a stopped job finishes later
(``sources.publish``); the period register moves last. A refused load changes nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.config import MartConfig
from starmart.functions import following_period, month_key, month_name
from starmart.operators.dedup import first_per_key
from starmart.operators.dimensions import (
    SEEDS,
    clean_airlines,
    clean_airports,
    municipalities,
    seed,
)
from starmart.operators.filters import in_periods
from starmart.operators.insert import absent_rows
from starmart.operators.summaries import latest_period
from starmart.plans import quality
from starmart.plans.fact import LOAD_PERIOD, cleaning_steps, fact_rows
from starmart.schemas import (
    DIMENSIONS,
    FACT_COLUMNS,
    FACT_PARTITIONS,
    FACT_TABLE,
    KEPT_COLUMNS,
    TABLES,
    key_of,
)
from starmart.session import size_shuffles
from starmart.sources import landing, paths, publish
from starmart.sources.dimension_files import read_airlines, read_airports
from starmart.sources.keys import KeyLog
from starmart.sources.raw import CORRUPT
from starmart.sources.warehouse import Warehouse, by_period

LOG = logging.getLogger(__name__)
READ_ERRORS = (PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class MartJob:
    """Where a mart lives: raw monthly files in, landed periods, warehouse out."""

    spark: SparkSession
    incoming: str
    landed: str
    warehouse: Warehouse
    config: MartConfig = field(default_factory=MartConfig)


def fill_dimensions(
    warehouse: Warehouse, airports: DataFrame, airlines: DataFrame, config: MartConfig
) -> None:
    """Insert what is new into the dimensions that do not depend on a period.

    Seeds and cleaned dimensions have unique keys.
    """
    for table in SEEDS:
        warehouse.insert_if_absent(table, seed(warehouse.spark, table), unique=True)
    warehouse.insert_if_absent("airports", clean_airports(airports, config), unique=True)
    cities = municipalities(warehouse.read("airports"))
    warehouse.insert_if_absent("municipalities", cities, unique=True)
    warehouse.insert_if_absent("airlines", clean_airlines(airlines, config), unique=True)


def set_up(
    warehouse: Warehouse, airports: DataFrame, airlines: DataFrame, config: MartConfig
) -> None:
    """Reset the warehouse and fill those dimensions."""
    warehouse.drop()
    warehouse.create()
    fill_dimensions(warehouse, airports, airlines, config)


def _with_period(arrivals: DataFrame, year: int, month: int) -> DataFrame:
    return arrivals.withColumns({"load_year": F.lit(year), "load_month": F.lit(month)})


def _pending_dimensions(
    warehouse: Warehouse, periods: dict[str, DataFrame]
) -> dict[str, DataFrame | None]:
    """The dimensions as they will be once the batch's periods are registered."""
    tables: dict[str, DataFrame | None] = {}
    for name in DIMENSIONS:
        table = warehouse.read(name) if warehouse.exists(name) else None
        if table is not None and name in periods:
            table = table.unionByName(periods[name])
        tables[name] = table
    return tables


Period = tuple[int, int]


def _observed_periods() -> Column:
    """The load periods of the rows that pass by; there are as many as months."""
    return F.collect_set(F.struct(*LOAD_PERIOD))


def _calendar_periods(periods: set[tuple]) -> set[Period]:
    return {(y, m) for y, m in periods if y is not None and m is not None and 1 <= m <= 12}


def _register_rows(spark: SparkSession, periods: set[Period], known: set[Period]) -> dict[str, DataFrame]:
    """Rows that the period dimensions lack for some months; a table that lacks none has no entry."""
    lacking = {
        "years": ({(y,) for y, _ in periods} - {(y,) for y, _ in known}, ("year",)),
        "months": ({(m,) for _, m in periods} - {(m,) for _, m in known}, ("month_num",)),
        "monthlytimes": (periods - known, ("year", "month_num")),
    }
    derived = {
        "months": {"month_name": month_name(F.col("month_num"))},
        "monthlytimes": {"monthlytime": month_key(F.col("year"), F.col("month_num"))},
    }
    tables = {}
    for table, (rows, names) in lacking.items():
        if rows:
            literals = [{n: F.lit(v) for n, v in zip(names, row, strict=True)} for row in sorted(rows)]
            frame = quality.literal_rows(spark, literals).withColumns(derived.get(table, {}))
            tables[table] = frame.select(*TABLES[table].fieldNames())
    return tables


def _registered(warehouse: Warehouse) -> set[Period]:
    if not warehouse.exists("monthlytimes"):
        return set()
    rows = warehouse.read("monthlytimes").select("year", "month_num").collect()  # one per loaded month
    return {(r.year, r.month_num) for r in rows}


@dataclass(frozen=True)
class Staged:
    """A batch written below the warehouse, what was counted on the way, and the months it has rows of."""

    rows: DataFrame
    report: DataFrame
    periods: set[Period]


def _stage(
    warehouse: Warehouse, arrivals: DataFrame, config: MartConfig, staging: str, within: Sequence[str] = ()
) -> Staged:
    """Write the fact rows of a batch; all counts of source and batch come from this one pass.

    The counts of the source are taken before the shuffle that finds duplicates. Should an executor be
    lost, its part is counted again, so they may be too high; only warnings depend on their size. The
    counts of the batch are those of the rows written.
    """
    spark = warehouse.spark
    qualifies = F.lit(True)
    for condition in cleaning_steps(config).values():
        qualifies = qualifies & condition
    corrupt = F.col(CORRUPT) if CORRUPT in arrivals.columns else None
    of_source = quality.source_metrics(qualifies, corrupt)
    of_batch = quality.batch_metrics(*LOAD_PERIOD)

    def watched(frame: DataFrame, seen: Observation, metrics: dict[str, Column]) -> DataFrame:
        counts = [m.alias(name) for name, m in metrics.items()]
        return frame.observe(seen, *counts, _observed_periods().alias("periods"))

    source_seen, batch_seen = Observation("source"), Observation("batch")
    source = watched(arrivals, source_seen, of_source).drop(CORRUPT)
    rows = fact_rows(source, warehouse.read("airports"), config, within)
    watched(rows, batch_seen, of_batch).write.mode("overwrite").parquet(staging)
    source_counts, batch_counts = source_seen.get, batch_seen.get
    delivered, loaded = ({tuple(p) for p in c.get("periods") or []} for c in (source_counts, batch_counts))
    report = quality.union(
        [
            quality.source_report(quality.measured(spark, source_counts, list(of_source))),
            quality.period_check(spark, delivered, loaded),
            quality.batch_report(
                quality.measured(spark, batch_counts, list(of_batch)),
                len([c for c in rows.columns if c not in LOAD_PERIOD]),
            ),
        ]
    )
    batch = spark.read.schema(rows.schema).parquet(staging)
    return Staged(batch, report, _calendar_periods(loaded))


def _stage_new(warehouse: Warehouse, rows: DataFrame, known: DataFrame | None, folder: str) -> tuple[int, set[Period]]:
    """Write the rows whose key is not known, laid out as the fact; returns how many, and their months."""
    new = rows if known is None else absent_rows(rows, known, key_of(FACT_TABLE), unique=True)
    seen = Observation("new")
    counts = F.count(F.lit(1)).alias("rows"), F.collect_set(F.struct(*FACT_PARTITIONS)).alias("periods")
    written = by_period(new.select(*FACT_COLUMNS)).observe(seen, *counts)
    written.write.mode("overwrite").partitionBy(*FACT_PARTITIONS).parquet(folder)
    found = seen.get
    return found.get("rows") or 0, {tuple(p) for p in found.get("periods") or []}


@dataclass(frozen=True)
class Loaded:
    """Rows added, the months they were delivered for, and those that were refused, with the reason."""

    added: int
    periods: set[Period]
    refused: dict[Period, str]


def _load(
    warehouse: Warehouse,
    arrivals: DataFrame,
    config: MartConfig,
    delivered: set[Period] | None = None,
    restated: Period | None = None,
) -> Loaded:
    """Stage, check and publish a batch.

    It is refused as a whole, or, where ``delivered`` names its months, month by month. The rows of
    ``restated`` are replaced instead of added to.
    """
    spark, key = warehouse.spark, key_of(FACT_TABLE)
    warehouse.finish()
    if not warehouse.exists(FACT_TABLE):
        quality.enforce(quality.single_check(spark, "fact_exists", False, 0, "table"))
    batch_folder, ready = warehouse.scratch("staged-facts"), warehouse.scratch("ready")
    planned = False
    try:
        apart = delivered is not None
        staged = _stage(warehouse, arrivals, config, batch_folder, LOAD_PERIOD if apart else ())
        registered, refused = _registered(warehouse), {}
        pending = _pending_dimensions(warehouse, _register_rows(spark, staged.periods, registered))
        dimensions = quality.dimension_checks(spark, pending)
        if apart:
            refused = {p: "batch_not_empty: 0, expected > 0" for p in delivered - staged.periods}
            refused |= quality.failed_by_period(quality.period_reports(staged.rows, *LOAD_PERIOD), *LOAD_PERIOD)
            quality.enforce(dimensions)
        else:
            quality.enforce(quality.union([staged.report, dimensions]))
        periods = staged.periods - refused.keys()
        if not periods:
            return Loaded(0, periods, refused)
        rows = staged.rows
        if apart:
            rows = rows.filter(in_periods(periods, *LOAD_PERIOD))
            rows = first_per_key(rows, [key], LOAD_PERIOD) if len(periods) > 1 else rows
        rows = rows.select(*FACT_COLUMNS)

        keys = _ready_keys(warehouse)
        known = None if keys.is_empty() else keys.known(among=rows)
        before = None
        if restated:
            before = warehouse.read(FACT_TABLE).filter(in_periods([restated], *FACT_PARTITIONS)).select(key)
            known = known.join(before, key, "left_anti")
        added, found = _stage_new(warehouse, rows, known, f"{ready}/fact")
        new = spark.read.schema(TABLES[FACT_TABLE]).parquet(f"{ready}/fact").select(key)
        changes = new.withColumn("present", F.lit(True))
        if restated:
            retired = before.join(new, key, "left_anti").withColumn("present", F.lit(False))
            changes = changes.join(before, key, "left_anti").union(retired)
        change = publish.last_change(spark, warehouse.root) + 1
        repeated = keys.stage(changes, change, f"{ready}/keys")

        idle = {p for p in periods if p not in found and not warehouse.has_period(*p)}
        checks = [quality.repeated_keys_check(spark, repeated)]
        if apart:
            refused |= dict.fromkeys(idle, "fact_grew: 0, expected > 0 in every new period")
            periods -= idle
        else:
            checks.append(quality.growth_check(spark, added, len(idle) + (restated is not None and not added)))
        quality.enforce(quality.union(checks))

        plan = publish.Plan()
        if restated:
            folder = warehouse.period_path(*restated)
            plan.replaced = [f"{folder}/{name}" for name in paths.files_in(spark, folder)]
        plan.staged(f"{ready}/fact", warehouse.path(FACT_TABLE))
        plan.staged(f"{ready}/keys", keys.path)
        for table, frame in _register_rows(spark, periods, registered).items():
            frame.coalesce(1).write.parquet(f"{ready}/{table}")
            plan.staged(f"{ready}/{table}", warehouse.path(table))
        planned = True
        publish.publish(spark, warehouse.root, plan)
        paths.delete(spark, ready)
        return Loaded(added, periods, refused)
    finally:
        paths.delete(spark, batch_folder)
        if not planned:
            paths.delete(spark, ready)


def _ready_keys(warehouse: Warehouse) -> KeyLog:
    """The log of the fact's keys; made from the fact where that is older than the log."""
    keys = warehouse.keys()
    if not keys.exists():
        if not warehouse.is_empty(FACT_TABLE):
            old = warehouse.read(FACT_TABLE).select(key_of(FACT_TABLE)).withColumn("present", F.lit(True))
            folder = warehouse.scratch("keys")
            keys.stage(old, 0, folder)
            paths.move(warehouse.spark, folder, keys.path)
        else:
            paths.make_folder(warehouse.spark, keys.path)
    return keys


def load_batch(warehouse: Warehouse, arrivals: DataFrame, config: MartConfig) -> int:
    """Check and add one batch of raw arrivals; returns the number of new fact rows.

    ``arrivals`` has the raw columns used by the fact, and ``load_year`` and ``load_month`` with
    the period each row was delivered for; a column with the text of corrupt rows is counted. A
    batch may cover many periods; it is loaded as a whole or refused as a whole.
    """
    return _load(warehouse, arrivals, config).added


def registered_period(warehouse: Warehouse) -> tuple[int, int]:
    """Latest loaded ``(year, month)``; the register has to exist and to have rows."""
    warehouse.finish()
    if not warehouse.exists("monthlytimes"):
        raise quality.QualityError("monthlytimes does not exist")
    latest = latest_period(warehouse.read("monthlytimes"), "year", "month_num").first()
    if latest["year"] is None:
        raise quality.QualityError("monthlytimes has no rows")
    return latest["year"], latest["month_num"]


def next_period(warehouse: Warehouse) -> tuple[int, int]:
    year, month = registered_period(warehouse)
    following = (
        warehouse.spark.range(1)
        .select(following_period(F.lit(year), F.lit(month)).alias("p"))
        .select("p.*")
        .first()
    )
    return following["year"], following["month_num"]


def _landed(job: MartJob, periods: Iterable[Period]) -> DataFrame:
    """The landed arrivals of some months, as a batch."""
    names = {"year": "load_year", "month": "load_month"}
    rows = landing.read_landed_periods(job.spark, job.landed, periods).withColumnsRenamed(names)
    return rows.select(*KEPT_COLUMNS, CORRUPT, *LOAD_PERIOD)


def load_deliveries(job: MartJob, periods: Iterable[Period]) -> Loaded:
    """Land and load the raw files of some months together; each is loaded or refused by itself.

    A month is refused if its file cannot be read, or its rows fail a check, or it adds no row though
    it is new. Its landed copy is removed, so that a corrected file lands. An arrival that several of
    the months loaded have belongs to the earliest of them.
    """
    wanted, unread = set(periods), {}
    try:
        landing.land_all(job.spark, job.incoming, job.landed, wanted)
    except READ_ERRORS as error:  # one of the files: found by landing each alone
        LOG.warning("files are landed one by one: %s", str(error).splitlines()[0])
        for period in sorted(wanted):
            try:
                landing.land_all(job.spark, job.incoming, job.landed, [period])
            except READ_ERRORS as own:
                unread[period] = f"unreadable: {_cause(own)}"
        wanted -= unread.keys()
        if not wanted and len(unread) > 1:
            raise
    loaded = Loaded(0, set(), {})
    if wanted:
        folders = [landing.landed_path(job.landed, *p) for p in wanted]
        size_shuffles(job.spark, paths.size_of(job.spark, *folders))
        loaded = _load(job.warehouse, _landed(job, wanted), job.config, delivered=wanted)
    refused = loaded.refused | unread
    for period in refused:
        paths.delete(job.spark, landing.landed_path(job.landed, *period))
    return Loaded(loaded.added, loaded.periods, refused)


def _cause(error: Exception) -> str:
    """The first line of the innermost message."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    return next((line for line in lines if line.startswith("CSV")), lines[0] if lines else type(error).__name__)


def restate_period(job: MartJob, year: int, month: int) -> int:
    """Land the corrected file of a loaded month and put its rows in place of the old ones.

    Returns how many rows the month has now. No other month is touched: a number that another month
    has stays there. Numbers the month no longer has may come with a later file.
    """
    job.warehouse.finish()
    if not job.warehouse.has_period(year, month):
        raise quality.QualityError(f"{month}_{year} is not loaded")
    landing.land(job.spark, job.incoming, job.landed, year, month, force=True)
    landed = landing.read_landed(job.spark, job.landed, year, month, corrupt=True).select(*KEPT_COLUMNS, CORRUPT)
    arrivals = _with_period(landed, year, month)
    return _load(job.warehouse, arrivals, job.config, restated=(year, month)).added


def load_period(job: MartJob, year: int, month: int, force: bool = False) -> int:
    """Land the raw file of a period if it has not landed, and load it.

    With ``force`` the file is landed again: after a refused load the corrected one is read.
    """
    landing.land(job.spark, job.incoming, job.landed, year, month, force)
    source = landing.landed_path(job.landed, year, month)
    size_shuffles(
        job.spark, paths.size_of(job.spark, source, job.warehouse.path(FACT_TABLE))
    )
    landed = landing.read_landed(job.spark, job.landed, year, month, corrupt=True)
    arrivals = landed.select(*KEPT_COLUMNS, CORRUPT)
    return load_batch(job.warehouse, _with_period(arrivals, year, month), job.config)


def bootstrap(
    job: MartJob, airports_csv: str, airlines_json: str, year: int, month: int, force: bool = False
) -> int:
    """First run: reset, fill the dimensions from their files and load the first period."""
    set_up(
        job.warehouse,
        read_airports(job.spark, airports_csv),
        read_airlines(job.spark, airlines_json),
        job.config,
    )
    return load_period(job, year, month, force)


def advance(job: MartJob, force: bool = False) -> tuple[int, int, int]:
    """Load the month after the latest one; returns year, month and the number of new rows."""
    year, month = next_period(job.warehouse)
    return year, month, load_period(job, year, month, force)
