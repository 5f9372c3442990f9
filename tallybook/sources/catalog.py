"""Hands named tables to the reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from tallybook.functions.periods import DAYS_OF, ZONE
from tallybook.lineage import compute_once
from tallybook.sources.schemas import SCHEMAS


@dataclass(frozen=True)
class DayLayout:
    """A table is partitioned by ``column``, the day of its timestamp ``time`` in a zone."""

    time: str
    column: str
    tz: str = "UTC"

    def mark(self, df: DataFrame) -> DataFrame:
        """The table with its day column marked, for every window on ``time`` to prune by."""
        return df.withMetadata(self.column, {DAYS_OF: self.time, ZONE: self.tz})


class Catalog:
    """Tables by name, as attributes; each is opened once, when first asked for.

    A catalog is one run's view of the tables: models that several reports derive from them are kept with it.
    """

    def __init__(self, opener: Callable[[str], DataFrame]):
        self._opener = opener
        self._opened: dict[str, DataFrame] = {}
        self._kept: dict[tuple, DataFrame] = {}

    def once(self, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived model by key: made and stored when first asked for, handed to every report of the run."""
        if key not in self._kept:
            self._kept[key] = compute_once(build())
        return self._kept[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = self._opener(name)
        return self._opened[name]

    def replacing(self, **frames: DataFrame) -> "Catalog":
        """The same catalog with some tables given directly."""
        return Catalog(lambda name: frames[name] if name in frames else getattr(self, name))

    @classmethod
    def of(cls, **frames: DataFrame) -> "Catalog":
        return cls(frames.__getitem__)

    @classmethod
    def parquet(cls, spark: SparkSession, root: str, layouts: Mapping[str, DayLayout] | None = None) -> "Catalog":
        """One directory per table under ``root``, read with the declared schema and layout."""
        layouts = layouts or {}

        def opened(name: str) -> DataFrame:
            layout = layouts.get(name)
            if layout is None:
                return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")
            schema = StructType([*SCHEMAS[name].fields, StructField(layout.column, DateType())])
            return layout.mark(spark.read.schema(schema).parquet(f"{root}/{name}"))

        return cls(opened)

    @classmethod
    def tables(cls, spark: SparkSession, database: str, layouts: Mapping[str, DayLayout] | None = None) -> "Catalog":
        """Tables of a metastore database, with the layouts of those that are partitioned by day."""
        layouts = layouts or {}

        def opened(name: str) -> DataFrame:
            table = spark.table(f"{database}.{name}")
            return layouts[name].mark(table) if name in layouts else table

        return cls(opened)
