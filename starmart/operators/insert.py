"""Insert-if-absent: a key that exists keeps its first row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.dedup import first_per_key
from starmart.operators.lookup import fits_broadcast


def keys_met(history: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Keys of ``history`` that a batch may meet, for a history far larger than the batch.

    When the batch's keys are measured to be few they are broadcast to the history, which then
    is not shuffled. Otherwise these are all its keys, and the anti join shuffles them.
    """
    known = history.select(key)
    if fits_broadcast(batch.select(key)):
        return known.join(F.broadcast(batch.select(key)), key, "left_semi")
    return known


def absent_rows(
    incoming: DataFrame, existing: DataFrame, key: str, unique: bool = False
) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``, one row per new key.

    ``unique`` says that ``incoming`` holds no key twice and none that is null.
    """
    candidates = (
        incoming if unique else first_per_key(incoming.filter(F.col(key).isNotNull()), [key])
    )
    return candidates.join(existing.select(key), key, "left_anti").select(*incoming.columns)


def insert_if_absent(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The table after the insert: all existing rows and the absent ones."""
    return existing.unionByName(absent_rows(incoming, existing, key))
