"""Warehouse: the star schema as Parquet tables under one root folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from starmart.operators.insert import absent_rows
from starmart.schemas import FACT_PARTITIONS, FACT_TABLE, TABLES, key_of
from starmart.sources import paths, publish
from starmart.sources.keys import KeyLog


class Warehouse:
    """Tables addressed by name. One writer at a time; readers may come and go."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return paths.exists(self.spark, self.path(table))

    def scratch(self, purpose: str) -> str:
        """New folder below the root for an intermediate table; whoever writes it deletes it."""
        return f"{self.root}/_scratch/{purpose}-{uuid.uuid4().hex}"

    def has_period(self, year: int, month: int) -> bool:
        """Whether the fact has rows of a period, told by its partition folder."""
        return paths.exists(self.spark, self.period_path(year, month))

    def create(self, tables: Iterable[str] = tuple(TABLES)) -> None:
        """Create the tables that do not exist, without rows: a folder with a declared layout."""
        for table in tables:
            if not self.exists(table):
                paths.make_folder(self.spark, self.path(table))

    def drop(self, tables: Iterable[str] = tuple(TABLES)) -> None:
        """Remove the tables that exist; with the fact go its keys."""
        self.finish()
        for table in tables:
            if self.exists(table):
                paths.delete(self.spark, self.path(table))
        if FACT_TABLE in tables and self.keys().exists():
            self.keys().drop()

    def finish(self) -> None:
        """Carry out what a stopped job had begun to publish. Every job starts with this."""
        publish.finish(self.spark, self.root)

    def keys(self) -> KeyLog:
        return KeyLog(self.spark, self.root)

    def is_empty(self, table: str) -> bool:
        """Whether a table has no data file yet."""
        return not paths.files_in(self.spark, self.path(table))

    def period_path(self, year: int, month: int) -> str:
        of_year, of_month = FACT_PARTITIONS
        return f"{self.path(FACT_TABLE)}/{of_year}={year}/{of_month}={month}"

    def read(self, table: str) -> DataFrame:
        """The whole table in its declared column order; unused columns and periods are pruned."""
        schema = TABLES[table]
        return (
            self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.fieldNames())
        )

    def append(self, table: str, rows: DataFrame) -> None:
        self._write(rows.select(*TABLES[table].fieldNames()), table)

    def insert_if_absent(self, table: str, rows: DataFrame, unique: bool = False) -> None:
        if not (unique and self.is_empty(table)):
            rows = absent_rows(rows, self.read(table), key_of(table), unique)
        self.append(table, rows)

    def count(self, table: str) -> int:
        return self.read(table).count()

    def register_views(self) -> None:
        """Make every existing table available to ``spark.sql`` under its name."""
        for table in TABLES:
            if self.exists(table):
                self.read(table).createOrReplaceTempView(table)

    def _write(self, rows: DataFrame, table: str) -> None:
        # Dimensions are written as they come from a shuffle, whose partitions Spark has merged by size.
        writer = rows.write
        if table == FACT_TABLE:
            writer = by_period(rows).write.partitionBy(*FACT_PARTITIONS)
        writer.mode("append").parquet(self.path(table))


def by_period(rows: DataFrame) -> DataFrame:
    """Fact rows gathered for writing: files of the advisory size, large periods split over tasks, so
    many periods at once do not leave a file per task and period.
    """
    return rows.hint("rebalance", *FACT_PARTITIONS)
