"""Date-partitioned tables of one folder whose changes appear together.

A run writes the dates it changes to folders of its own, ``table/v=run/date``, which nobody reads yet. Then one small list,
``manifest/run=n``, names the folders that hold each date of each table, and counts from the moment its write has ended. So readers see
all tables before the run or all after it; a run that fails or is killed before leaves everything as it was; and a
reader that began with the list before keeps its files until two lists later. Two runs at a time can't both end: the
second finds its list taken.

A list may also hold marks, such as the last batch of a stream, which take effect with the tables they belong to.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.sinks.tables import NO_DATE, date_files, folder_names, ready_rows, remove_folder

MANIFEST, RUN, VERSION, MARK = "manifest", "run=", "v=", "mark"
CARRY, PROFILES = "carry", "profiles"  # what is kept of Silver: the state of each product, the counts of each date
IN_PLACE = -1  # dates written straight below the table's folder, by write_table
SCHEMA = "kind string, name string, date string, version long"


class ConflictError(RuntimeError):
    """Another run ended while this one was at work."""


class Manifest:
    """The folders of each date: {table: {date: [versions]}}, and the marks."""

    def __init__(self, number: int = -1, tables: dict[str, dict[str, list[int]]] | None = None, marks: dict[str, int] | None = None):
        self.number, self.tables, self.marks = number, tables or {}, marks or {}


def read_manifest(spark: SparkSession, out: str, number: int | None = None) -> Manifest:
    """The newest list of a folder, or one by number; an empty one before the first."""
    known = sorted(map(int, folder_names(spark, f"{out}/{MANIFEST}", RUN, complete=True)))
    if not known or number is not None and number not in known:
        return Manifest()
    number = known[-1] if number is None else number
    found = Manifest(number)
    # one row for each table, date and version
    for kind, name, date, version in spark.read.schema(SCHEMA).parquet(f"{out}/{MANIFEST}/{RUN}{number}").collect():
        if kind == MARK:
            found.marks[name] = version
        else:
            dates = found.tables.setdefault(name, {})
            if date is not None:
                dates.setdefault(date, []).append(version)
    return found


def _read(spark: SparkSession, path: str, dates: dict[str, list[int]], schema: T.StructType, partition: str) -> DataFrame:
    """The dates of a table. Paths that name their date keep the partitions prunable."""
    placed = [f"{path}/{partition}={d}" for d, vs in dates.items() if IN_PLACE in vs]
    versioned = [f"{path}/{VERSION}{v}/{partition}={d}" for d, vs in dates.items() for v in vs if v != IN_PLACE]
    parts = [spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.fieldNames())
             for paths in (placed, versioned) if paths]
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def read_listed(spark: SparkSession, path: str, schema: T.StructType, partition: str) -> DataFrame | None:
    """The table at a path as the list of its folder has it; None if there is no list or the table isn't on it."""
    out, _, name = path.rstrip("/").rpartition("/")
    known = read_manifest(spark, out)
    return _read(spark, path.rstrip("/"), known.tables[name], schema, partition) if name in known.tables else None


class Changes:
    """What one run changes. Nothing of it is seen by others before commit()."""

    def __init__(self, spark: SparkSession, out: str, partition: str = "scrape_date"):
        self.spark, self.out, self.partition = spark, out.rstrip("/"), partition
        self.base = read_manifest(spark, self.out)
        self.number = 1 + max([-1, *map(int, folder_names(spark, f"{self.out}/{MANIFEST}", RUN))])
        self.tables = {name: dict(dates) for name, dates in self.base.tables.items()}
        self.marks = dict(self.base.marks)

    def dates(self, name: str) -> dict[str, list[int]] | None:
        """The folders of a table's dates so far; those written in place, if it was on no list yet; None if it is new."""
        if name not in self.tables:
            found = date_files(self.spark, f"{self.out}/{name}", self.partition)
            return {date: [IN_PLACE] for date in found} if found else None
        return self.tables[name]

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """A table with what this run has written to it. Its files are never written over, so they may be read while it is written anew."""
        return _read(self.spark, f"{self.out}/{name}", self.dates(name) or {}, schema, self.partition)

    def write(self, rows: DataFrame, name: str, *, append: bool = False, replace_all: bool = False,
              replace_from: dt.date | None = None) -> int:
        """Replace the dates that the rows hold (or add to them) and return the number of rows written.

        With ``replace_all`` all other dates go, with ``replace_from`` the others from that date on; rows without a date are no such date.
        """
        path = f"{self.out}/{name}/{VERSION}{self.number}"
        if self.number in {v for versions in (self.dates(name) or {}).values() for v in versions}:
            raise ValueError(f"{name} was written by this run already")
        ready, seen = ready_rows(rows, self.partition)
        (ready.write.option("partitionOverwriteMode", "static").partitionBy(self.partition).mode("overwrite").parquet(path))
        before = {} if replace_all else {
            date: versions for date, versions in (self.dates(name) or {}).items()
            if replace_from is None or date == NO_DATE or date[:10] < replace_from.isoformat()}
        written = date_files(self.spark, path, self.partition)
        self.tables[name] = before | {date: (before.get(date, []) if append else []) + [self.number] for date in written}
        return seen.get.get("rows", 0)

    def written(self, name: str) -> list[str]:
        """The dates of a table that this run has written."""
        return [date for date, versions in self.tables.get(name, {}).items() if self.number in versions]

    def drop_from(self, name: str, dates: list[str]) -> None:
        """Take a table's dates from the first of some on off the list; rows without a date change none."""
        first = min((date for date in dates if date != NO_DATE), default=None)
        if first is not None and name in self.tables:
            self.tables[name] = {date: versions for date, versions in self.tables[name].items() if date < first}

    def drop(self, name: str, dates: list[str]) -> None:
        """Take dates of a table off the list."""
        if name in self.tables:
            self.tables[name] = {date: versions for date, versions in self.tables[name].items() if date not in dates}

    def commit(self) -> int:
        """Make all that was written appear, and remove what neither this list nor the one before names."""
        rows = [("table", name, date, version) for name, dates in self.tables.items() for date, versions in dates.items() for version in versions]
        rows += [("table", name, None, None) for name, dates in self.tables.items() if not dates]
        rows += [(MARK, name, None, value) for name, value in self.marks.items()]
        path = f"{self.out}/{MANIFEST}"
        if sorted(map(int, folder_names(self.spark, path, RUN, complete=True)))[-1:] not in ([], [self.base.number]):
            raise ConflictError(f"another run has changed {self.out}")
        try:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{path}/{RUN}{self.number}")
        except AnalysisException as taken:
            raise ConflictError(f"another run has changed {self.out}") from taken
        self._clean()
        return self.number

    def _clean(self) -> None:
        kept = {(name, date, v) for tables in (self.tables, self.base.tables) for name, dates in tables.items()
                for date, versions in dates.items() for v in versions}
        for name in self.tables:
            root = f"{self.out}/{name}"
            for version in map(int, folder_names(self.spark, root, VERSION)):
                if version > self.number:
                    continue
                dates = date_files(self.spark, f"{root}/{VERSION}{version}", self.partition)
                gone = [date for date in dates if (name, date, version) not in kept]
                if len(gone) == len(dates):
                    remove_folder(self.spark, f"{root}/{VERSION}{version}")
                else:
                    for date in gone:
                        remove_folder(self.spark, f"{root}/{VERSION}{version}/{self.partition}={date}")
            if name in self.base.tables:  # in its second list, those in place that were replaced
                for date in date_files(self.spark, root, self.partition):
                    if (name, date, IN_PLACE) not in kept:
                        remove_folder(self.spark, f"{root}/{self.partition}={date}")
        for number in map(int, folder_names(self.spark, f"{self.out}/{MANIFEST}", RUN)):
            if number < self.base.number:
                remove_folder(self.spark, f"{self.out}/{MANIFEST}/{RUN}{number}")


def partition_places(spark: SparkSession, out: str, name: str, partition: str = "scrape_date") -> dict[str, list[str]]:
    """The folders of each date of a table, for a catalog."""
    return {date: [f"{out}/{name}/" + (f"{VERSION}{v}/" if v != IN_PLACE else "") + f"{partition}={date}" for v in versions]
            for date, versions in read_manifest(spark, out).tables.get(name, {}).items()}
