"""Versioned rows by day, kept by the micro-batches of a stream.

A batch appends new versions of some keys; the version of the latest batch counts. Rows lie
in ``day=<date>/run=<level>_<first>_<last>``: a batch's own rows are a run of level 0, and as
soon as a day has ``fold_at`` runs of a level they are folded into one run of the next level
that holds the latest version of each key. After ``n`` batches a day has fewer than
``fold_at`` runs of each of ``log(n)`` levels, every row is rewritten once for each level, and
a batch lists the folders of the days it asks for and no others.

A run is written under its final name in one step, covers a known range of batches and
replaces the runs inside that range, which are deleted afterwards. So a batch that runs
again, after a crash at any point, finds the same versions as the first time: what it wrote
itself is left out, and runs that lie inside a larger one are not read.

Inside a run rows are sorted by ``sort``, so that a range on these columns skips most of
the row groups of a large day.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skylattice.functions import quoted
from skylattice.scratch import delete, list_folders

#: Runs of one level that a day may have.
FOLD_AT = 8
#: Name of the folder of rows without a day, as Spark's writer calls it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True, order=True)
class Run:
    first: int
    last: int
    level: int

    @property
    def folder(self) -> str:
        return f"run={self.level}_{self.first}_{self.last}"

    @classmethod
    def parse(cls, folder: str) -> Run:
        level, first, last = map(int, folder.removeprefix("run=").split("_"))
        return cls(first, last, level)

    def inside(self, other: Run) -> bool:
        return other.level > self.level and other.first <= self.first and self.last <= other.last


class VersionStore:
    """``columns`` are those of the rows without ``day`` and ``batch``, which are added."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        columns: T.StructType,
        key: Sequence[str],
        sort: Sequence[str] = (),
        fold_at: int = FOLD_AT,
    ):
        if fold_at < 2:
            raise ValueError("fold_at must be at least 2")
        self.spark, self.path, self.key, self.fold_at = spark, path.rstrip("/"), key, fold_at
        self.columns = T.StructType([*columns.fields, T.StructField("batch", T.LongType())])
        self.schema = T.StructType(
            [*self.columns.fields, T.StructField("run", T.StringType()),
             T.StructField("day", T.DateType())]
        )
        self.sort = tuple(sort) or tuple(key)

    # --- folders ---------------------------------------------------------------

    def days(self) -> list[str]:
        """All days there are, as in the folders' names."""
        return [name.removeprefix("day=") for name in list_folders(self.spark, self.path, "day=")]

    def runs(self, day: str, before: int | None = None) -> list[Run]:
        """Runs that make up a day, without those of batch ``before`` and later ones."""
        folders = list_folders(self.spark, f"{self.path}/day={day}", "run=")
        found = [Run.parse(name) for name in folders]
        found = [r for r in found if before is None or r.last < before]
        return sorted(r for r in found if not any(r.inside(other) for other in found))

    def _paths(self, runs: dict[str, list[Run]]) -> list[str]:
        return [f"{self.path}/day={day}/{run.folder}" for day, own in runs.items() for run in own]

    # --- rows --------------------------------------------------------------------

    def rows(
        self, days: Iterable[str], before: int | None = None, where: str = "true"
    ) -> DataFrame:
        """Latest version of each key of these days; ``where`` must not tell versions apart."""
        return self._latest(self._read({day: self.runs(day, before) for day in days}, where))

    def versions(
        self, days: Iterable[str], before: int | None = None, where: str = "true"
    ) -> DataFrame | None:
        """All versions of each key of these days that are not folded yet; None if no day is there.

        For callers that look for the latest version in a shuffle of their own.
        """
        runs = {day: self.runs(day, before) for day in days}
        return self._read(runs, where) if any(runs.values()) else None

    def _read(self, runs: dict[str, list[Run]], where: str = "true") -> DataFrame:
        paths = self._paths(runs)
        if not paths:
            return self.spark.createDataFrame([], self.schema).drop("run")
        read = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        return read.filter(where).drop("run")

    def _latest(self, rows: DataFrame) -> DataFrame:
        key = ", ".join(map(quoted, ("day", *self.key)))
        rank = f"row_number() over (partition by {key} order by batch desc)"
        return rows.withColumn("_version", F.expr(rank)).filter("_version = 1").drop("_version")

    def append(self, rows: DataFrame, number: int) -> None:
        """Write the versions of a batch; a batch that runs again replaces its own."""
        run = F.lit(Run(number, number, 0).folder.removeprefix("run="))
        self._write(rows.withColumn("batch", F.lit(number).cast("long")).withColumn("run", run))

    def _write(self, rows: DataFrame) -> None:
        (
            rows.select(*(quoted(name) for name in self.schema.names))
            .hint("rebalance", "day", "run")
            .sortWithinPartitions("day", "run", *map(quoted, self.sort))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "run")
            .parquet(self.path)
        )

    def fold(self, days: Iterable[str], number: int) -> None:
        """Fold what batches before ``number`` wrote where a day has too many runs."""
        due: dict[str, tuple[Run, list[Run]]] = {}
        for day in days:
            runs = self.runs(day, number)
            self._delete_folded(day, runs, number)
            if folded := self._due(runs):
                level = max(r.level for r in folded) + 1
                due[day] = (Run(folded[0].first, folded[-1].last, level), folded)
        if not due:
            return
        rows = self._latest(self._read({day: folded for day, (_, folded) in due.items()}))
        names = F.create_map(
            *(F.lit(x) for day, (run, _) in due.items()
              for x in (day, run.folder.removeprefix("run=")))
        )
        day = F.coalesce(F.col("day").cast("string"), F.lit(NO_DAY))
        self._write(rows.withColumn("run", F.element_at(names, day)))
        for day in due:
            self._delete_folded(day, self.runs(day, number), number)

    def _due(self, runs: list[Run]) -> list[Run]:
        """The runs to fold into one: the lowest levels, as far as each is full."""
        folded: list[Run] = []
        for level in range(max((r.level for r in runs), default=-1) + 1):
            own = [r for r in runs if r.level == level]
            if len(own) + bool(folded) < self.fold_at:
                break
            folded += own
        return sorted(folded)

    def _delete_folded(self, day: str, kept: list[Run], number: int) -> None:
        for name in list_folders(self.spark, f"{self.path}/day={day}", "run="):
            run = Run.parse(name)
            if run.last < number and run not in kept:
                delete(self.spark, f"{self.path}/day={day}/{name}")
