"""The keys of the fact as a log in buckets, so that no load shuffles the history.

A row says that from a change on a key is in the fact, or no longer is. The log is a Parquet table
clustered by key: Spark reads it already dealt by key, so joining a batch with it shuffles the batch
only, and the latest state of every key is found without moving it. The number of buckets is fixed when
the log is made and kept in the name of its folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.operators.lookup import fits_broadcast
from starmart.schemas import FACT_TABLE, key_of
from starmart.sources import paths

KEY = key_of(FACT_TABLE)
COLUMNS = f"{KEY} STRING, change BIGINT, present BOOLEAN"
FOLDER = "factkeys-"


class KeyLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        made = [name for name in paths.names_in(spark, root) if name.startswith(FOLDER)]
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = int(made[0].removeprefix(FOLDER)) if made else shuffles
        self.path = f"{root}/{FOLDER}{self.buckets}"

    def exists(self) -> bool:
        return paths.exists(self.spark, self.path)

    def is_empty(self) -> bool:
        return not paths.files_in(self.spark, self.path)

    def _table(self, path: str) -> str:
        """The bucketed folder as a table of this session."""
        name = f"starmart_keys_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet "
            f"CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return name

    def stage(self, changes: DataFrame, change: int, folder: str) -> int:
        """Write ``(key, present)`` rows to a folder, in the log's buckets; returns keys met more than once."""
        name = self._table(folder)
        counted = (
            changes.repartition(self.buckets, KEY)
            .groupBy(KEY)
            .agg(F.bool_or("present").alias("present"), F.count(F.lit(1)).alias("n"))
        )
        seen = Observation("keys")
        rows = counted.observe(seen, F.count_if(F.col("n") > 1).alias("repeated"))
        rows.select(KEY, F.lit(change).cast("bigint"), "present").write.insertInto(name)
        self.spark.sql(f"DROP TABLE {name}")
        return seen.get.get("repeated") or 0

    def drop(self) -> None:
        """Forget the table and remove its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(self.path)}")
        paths.delete(self.spark, self.path)

    def rows(self) -> DataFrame:
        name = self._table(self.path)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def known(self, among: DataFrame | None = None) -> DataFrame:
        """Keys in the fact, read in their buckets; only those ``among`` a frame's if it is small.

        When the frame's keys are measured to be few they are sent to the log and only the keys met
        are looked at; otherwise the result is to be joined by key, which moves the other side.
        """
        rows = self.rows()
        if among is not None and fits_broadcast(among.select(KEY)):
            rows = rows.join(F.broadcast(among.select(KEY)), KEY, "left_semi")
        latest = rows.groupBy(KEY).agg(F.max_by("present", "change").alias("present"))
        return latest.filter("present").select(KEY)
