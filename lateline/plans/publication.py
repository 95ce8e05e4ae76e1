"""Tables written aside and put in place in one go that survives a crash.

A run stages its tables in a folder of its own and audits them there. Before the first folder moves, the list of all
moves is written as a journal beside the tables, under its final name only when it is complete. From then on the
publication takes place: should the run die at any point, whoever opens the store next makes the rest of the moves. Each
move can be made twice. Until the journal is there, nothing of a run shows.

One run at a time writes to a store.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lateline.workspace import delete, files, folders, path_exists, read_file, replace_folder, settle_folder, write_file


def journal_folder(root: str) -> str:
    return f"{root}/_journal"


def replay(spark: SparkSession, journal: str) -> int:
    """Makes the moves that a journal lists and that weren't made before; then the journal goes. How many were made."""
    listed, made = json.loads(read_file(spark, journal)), 0
    for source, target in listed["moves"]:
        if source is None:
            delete(spark, target)
        elif path_exists(spark, source):
            replace_folder(spark, source, target)
            made += 1
        else:
            settle_folder(spark, target)
    delete(spark, listed["folder"])
    delete(spark, journal)
    return made


def recover(spark: SparkSession, root: str) -> int:
    """Finishes what an earlier run began to publish. A journal that was never completed has no effect."""
    folder = journal_folder(root)
    return sum(replay(spark, f"{folder}/{name}") for name in files(spark, folder) if name.endswith(".json"))


@dataclass
class Staged:
    """Tables of one run beside those of a store."""

    spark: SparkSession
    root: str
    run: str
    moves: list[tuple[str | None, str]] = field(default_factory=list)

    @property
    def folder(self) -> str:
        return f"{self.root}/_staging/{self.run}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def target(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, model: DataFrame, name: str, by: str | None = None, *, gathered: bool = False) -> DataFrame:
        """Stages a table, its folders cut ``by`` a column; ``gathered`` if its rows have been rebalanced by that already."""
        writer = (model.hint("rebalance", by) if by and not gathered else model).write
        (writer.partitionBy(by) if by else writer).parquet(self.path(name))
        return self.spark.read.schema(model.schema).parquet(self.path(name))

    def stored(self, name: str, like: DataFrame) -> DataFrame:
        """The table as it is now, empty if there is none."""
        path = self.target(name)
        if not path_exists(self.spark, path):
            return like.limit(0)
        return self.spark.read.schema(like.schema).parquet(path).select(*like.columns)

    def replace(self, name: str, by: str | None = None, values: Sequence[str] | None = None) -> None:
        """Notes that a table, or its folders of the given values, are to be replaced by what has been staged; a value
        without staged rows goes."""
        if not path_exists(self.spark, self.path(name)):
            raise ValueError(f"{name} isn't staged")
        if by is None or values is None:
            self.moves.append((self.path(name), self.target(name)))
            return
        there = set(folders(self.spark, self.path(name)))
        for folder in (f"{by}={value}" for value in values):
            staged = f"{self.path(name)}/{folder}" if folder in there else None
            self.moves.append((staged, f"{self.target(name)}/{folder}"))

    def publish(self) -> None:
        """Makes the noted moves, all of them in the end."""
        journal = f"{journal_folder(self.root)}/{self.run}.json"
        write_file(self.spark, journal, json.dumps({"folder": self.folder, "moves": self.moves}))
        replay(self.spark, journal)

    def discard(self) -> None:
        """Throws the staged tables away, unless they are being published: then the next run needs them."""
        if not path_exists(self.spark, f"{journal_folder(self.root)}/{self.run}.json"):
            delete(self.spark, self.folder)
