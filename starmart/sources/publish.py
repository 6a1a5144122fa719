"""Publishing a load: staged files move into their tables, by a written plan.

A load stages the files of every table it changes and checks them there. Only then is its plan written:
which staged folders go into which tables, in order, and which files they replace. The files are then
moved by renaming. If the job stops, the plan is still there and ``finish`` takes it up: what has moved
is no longer in the stage, so every step can be repeated. Finished plans are kept under their number and
count the changes of a warehouse. There is one writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from starmart.sources import paths

OPEN, DONE = ".open", ".done"


@dataclass
class Plan:
    """``moves`` are pairs of a staged folder and its table's folder; ``replaced`` files go first."""

    moves: list[list[str]] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)

    def staged(self, folder: str, table: str) -> None:
        self.moves.append([folder, table])


def _folder(root: str) -> str:
    return f"{root}/_changes"


def last_change(spark: SparkSession, root: str) -> int:
    """Number of the last plan; 0 before the first."""
    return max((int(name.split(".")[0]) for name in paths.names_in(spark, _folder(root))), default=0)


def _carry_out(spark: SparkSession, plan: Plan) -> None:
    for file in plan.replaced:
        paths.delete(spark, file)
    for staged, table in plan.moves:
        for name in paths.files_in(spark, staged):
            paths.move(spark, f"{staged}/{name}", f"{table}/{name}")
    for staged, _ in plan.moves:
        paths.delete(spark, staged)


def publish(spark: SparkSession, root: str, plan: Plan) -> int:
    """Write the plan down and carry it out; returns its number."""
    number = last_change(spark, root) + 1
    paths.write_text(spark, f"{_folder(root)}/{number:08d}{OPEN}", json.dumps(asdict(plan)))
    finish(spark, root)
    return number


def finish(spark: SparkSession, root: str) -> None:
    """Carry out plans that a stopped job has left open."""
    folder = _folder(root)
    for name in paths.names_in(spark, folder):
        if name.endswith(OPEN):
            _carry_out(spark, Plan(**json.loads(paths.read_text(spark, f"{folder}/{name}"))))
            paths.move(spark, f"{folder}/{name}", f"{folder}/{name.removesuffix(OPEN)}{DONE}")
