"""Tables changed by key that keep old days as they are: merge on read.

A table is a folder with

    _table/<n>.json                     key, day and columns, the highest number counts
    <day>=<date>/gen=<g>/               the rows of a day, the highest generation counts;
    <day>=<date>/gone=<g>/              a day without rows
    _changes/version=<v>/               the rows of one change and the keys it deletes

A change is one appended folder, as large as the change, whatever days hold the keys it
replaces. A read takes the newest row of each changed key and, of the days, the rows whose
key no change names. Compaction writes the days that changes touch anew beside the old ones.
Each step is one rename of a finished folder, and the changes are only deleted, oldest
first, when all days are in place; as they hide whatever the days say about their keys, a
read is right after a failure at any point, and a repeated compaction goes on from there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from lakestay import fixed_values as fv
from lakestay.session import delete_folder

# Changes a table collects before its next change compacts it.
MOST_CHANGES = 24

_DELETED, _VERSION = "_deleted", "version"


class _Store:
    """Folders and small files of the table's file system."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.root = spark, table.rstrip("/")
        self.Path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.Path(f"{self.root}/{name}")

    def names(self, glob: str) -> list[str]:
        """Paths below the table that match, without its own path."""
        depth = glob.count("/") + 1
        found = self.fs.globStatus(self.at(glob)) or []
        return sorted("/".join(str(s.getPath()).split("/")[-depth:]) for s in found)

    def put(self, name: str, text: str) -> None:
        """A small file, there whole or not at all."""
        fresh = self.at(f"_fresh-{uuid.uuid4().hex}")
        out = self.fs.create(fresh, False)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.mkdirs(self.at(name).getParent())
        if not self.fs.rename(fresh, self.at(name)):
            raise OSError(f"cannot write {self.root}/{name}")

    def get(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return str(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> bool:
        """Rename a finished folder; False when the target is there already."""
        self.fs.mkdirs(self.at(target).getParent())
        if self.fs.exists(self.at(target)):
            return False
        return bool(self.fs.rename(self.at(source), self.at(target)))

    def drop(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def is_versioned(spark: SparkSession, table: str) -> bool:
    return bool(_Store(spark, table).names("_table/*.json"))


@dataclass
class VersionedTable:
    """A table with its rows in folders by a date column, changed by key."""

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    schema: StructType
    day: str = fv.BATCH_DATE

    # ---- opening ------------------------------------------------------------------

    @classmethod
    def create(
        cls, rows: DataFrame, path: str, key: Sequence[str], sort_by: Sequence[str] = (), day: str = fv.BATCH_DATE
    ) -> VersionedTable:
        """A new table of some rows; what a failed attempt left is deleted first."""
        spark = rows.sparkSession
        store = _Store(spark, path)
        if is_versioned(spark, path):
            raise FileExistsError(path)
        delete_folder(spark, path)
        schema = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields])
        table = cls(spark, path, tuple(key), schema, day)
        staged = table._staged(rows, sort_by)
        for folder in store.names(f"{staged}/*=*"):
            store.move(folder, f"{folder.split('/')[-1]}/gen=000000")
        store.drop(staged)
        table._describe(0)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VersionedTable:
        store = _Store(spark, path)
        found = store.names("_table/*.json")
        if not found:
            raise FileNotFoundError(f"no versioned table at {path}")
        known = json.loads(store.get(found[-1]))
        return cls(spark, path, tuple(known["key"]), StructType.fromJson(known["schema"]), known["day"])

    def _describe(self, number: int) -> None:
        text = json.dumps({"key": list(self.key), "day": self.day, "schema": json.loads(self.schema.json())})
        self._store().put(f"_table/{number:06d}.json", text)

    def _store(self) -> _Store:
        return _Store(self.spark, self.path)

    # ---- reading ------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The current rows; filters on the day prune folders."""
        return self._read(self._versions())

    def _read(self, versions: Sequence[str]) -> DataFrame:
        if not versions:
            return self._days()
        changes = self._changes(versions)
        kept = self._unchanged(self._days(), changes)
        return kept.unionByName(self._newest(changes).filter(~F.col(_DELETED)).drop(_DELETED))

    def _versions(self) -> list[str]:
        return self._store().names(f"_changes/{_VERSION}=*")

    def _day_folders(self) -> list[str]:
        """Of every day its newest folder, if it has rows."""
        newest: dict[str, str] = {}
        for name in self._store().names(f"{self.day}=*/*=*"):
            day, state = name.split("/")
            old = newest.get(day, "=")
            if state.split("=")[1] >= old.split("=")[1]:
                newest[day] = state
        return [f"{day}/{state}" for day, state in sorted(newest.items()) if state.startswith("gen=")]

    def _days(self) -> DataFrame:
        names = [f.name for f in self.schema.fields]
        folders = self._day_folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        body = self.spark.read.schema(self.schema).option("basePath", self.path)
        return body.parquet(*[f"{self.path.rstrip('/')}/{f}" for f in folders]).select(*names)

    def _changes(self, versions: Sequence[str]) -> DataFrame:
        fields = [*self.schema.fields, StructField(_DELETED, BooleanType()), StructField(_VERSION, IntegerType())]
        body = self.spark.read.schema(StructType(fields)).option("basePath", f"{self.path.rstrip('/')}/_changes")
        return body.parquet(*[f"{self.path.rstrip('/')}/{v}" for v in versions])

    def _unchanged(self, days: DataFrame, changes: DataFrame) -> DataFrame:
        return days.join(changes.select(*self.key), list(self.key), "left_anti").select(*days.columns)

    def _newest(self, changes: DataFrame) -> DataFrame:
        """The rows of the last change of each key; a NULL in a key equals nothing, so all such rows stay."""
        last = F.rank().over(Window.partitionBy(*self.key).orderBy(F.desc(_VERSION)))
        ranked = changes.dropna(subset=list(self.key)).withColumn("_last", last).filter("_last = 1").drop("_last")
        missing = " or ".join(f"`{k}` is null" for k in self.key)
        return ranked.unionByName(changes.filter(missing)).drop(_VERSION)

    # ---- changing -----------------------------------------------------------------

    def upsert(self, new: DataFrame, most_changes: int = MOST_CHANGES, sort_by: Sequence[str] = ()) -> int:
        """Delete all rows of the keys of new and insert its rows; the number of the change.

        Writes new alone and reads nothing of the table. Columns only new has are NULL in
        older rows and the other way round. The frame runs once. After most_changes changes
        the table is compacted.
        """
        return self._append(new.withColumn(_DELETED, F.lit(False)), most_changes, sort_by)

    def delete(self, keys: DataFrame, most_changes: int = MOST_CHANGES, sort_by: Sequence[str] = ()) -> int:
        """Delete all rows of some keys by a change that holds the keys alone."""
        gone = keys.select(*self.key).dropna().withColumn(_DELETED, F.lit(True))
        return self._append(gone, most_changes, sort_by)

    def _append(self, rows: DataFrame, most_changes: int, sort_by: Sequence[str]) -> int:
        store, staged = self._store(), f"_staged-{uuid.uuid4().hex}"
        added = [f for f in rows.schema.fields if f.name not in self.schema.names and f.name != _DELETED]
        self._agree(rows)
        try:
            rows.write.parquet(f"{self.path.rstrip('/')}/{staged}")
            if added:
                self.schema = StructType([*self.schema.fields, *[StructField(f.name, f.dataType) for f in added]])
                self._describe(int(store.names("_table/*.json")[-1][-11:-5]) + 1)
            number = int((self._versions() or ["=0"])[-1].split("=")[-1]) + 1
            while not store.move(staged, f"_changes/{_VERSION}={number:06d}"):
                number += 1  # another change was first
        finally:
            store.drop(staged)
        if len(self._versions()) > most_changes:
            self.compact(sort_by)
        return number

    def _agree(self, rows: DataFrame) -> None:
        """A column keeps its type."""
        for field in self.schema.fields:
            if field.name in rows.columns and rows.schema[field.name].dataType.simpleString() != field.dataType.simpleString():
                raise TypeError(f"{field.name}: {rows.schema[field.name].dataType} for {field.dataType}")

    # ---- batches that went in -------------------------------------------------------

    def applied(self) -> set[str]:
        """The batches noted as applied to this table."""
        return {n.split("/")[-1] for n in self._store().names("_applied/*")}

    def note_applied(self, batches: Iterable[str]) -> None:
        store = self._store()
        for batch in batches:
            store.fs.mkdirs(store.at(f"_applied/{batch}"))

    # ---- compaction ---------------------------------------------------------------

    def compact(self, sort_by: Sequence[str] = ()) -> list[str]:
        """Write the days that changes touch anew, then delete the changes; the days.

        Changes appended meanwhile stay. The folder of a day before the last is kept, so
        that reads under way can finish; older ones are deleted.
        """
        store, versions = self._store(), self._versions()
        if not versions:
            return []
        changes, days = self._changes(versions), self._days()
        replaced = days.select(*self.key, self.day).join(changes.select(*self.key), list(self.key), "left_semi")
        newest = self._newest(changes).filter(~F.col(_DELETED)).drop(_DELETED)
        touched = replaced.select(self.day).unionByName(newest.select(self.day)).distinct()
        touched = sorted(str(r[0]) for r in touched.collect())
        if touched:
            old = days.filter(F.col(self.day).isin([F.lit(d).cast("date") for d in touched]))
            staged = self._staged(self._unchanged(old, changes).unionByName(newest), sort_by)
            try:
                filled = {n.split("/")[-1]: n for n in store.names(f"{staged}/*=*")}
                for day in touched:
                    self._publish(f"{self.day}={day}", filled)
            finally:
                store.drop(staged)
        for version in versions:
            store.drop(version)
        return touched

    def _publish(self, day: str, filled: dict[str, str]) -> None:
        store = self._store()
        states = sorted(store.names(f"{day}/*=*"), key=lambda n: n.split("=")[-1])
        number = int(states[-1].split("=")[-1]) + 1 if states else 0
        if day in filled:
            if not store.move(filled[day], f"{day}/gen={number:06d}"):
                raise OSError(f"{self.path}: {day} was written by another compaction")
        else:
            store.fs.mkdirs(store.at(f"{day}/gone={number:06d}"))
        for old in states[:-1]:
            store.drop(old)

    def _staged(self, rows: DataFrame, sort_by: Sequence[str]) -> str:
        """The rows by day in a new folder of the table that reads pass over."""
        staged = f"_staged-{uuid.uuid4().hex}"
        if sort_by:  # files of a day hold ranges of the sort key
            body = rows.repartitionByRange(self.day, *sort_by).sortWithinPartitions(self.day, *sort_by)
        else:
            body = rows.hint("rebalance", self.day)
        body.write.partitionBy(self.day).parquet(f"{self.path.rstrip('/')}/{staged}")
        return staged


def change(
    new: DataFrame, path: str, key: Sequence[str], sort_by: Sequence[str] = (), day: str = fv.BATCH_DATE
) -> list[str]:
    """Upsert into a versioned table, made with these rows where there is none; the days of the rows."""
    spark = new.sparkSession
    if is_versioned(spark, path):
        table = VersionedTable.open(spark, path)
        number = table.upsert(new, most_changes=1 << 30, sort_by=sort_by)
        own = table._changes([f"_changes/{_VERSION}={number:06d}"]).select(table.day).distinct().collect()
        days = sorted(str(r[0]) for r in own)
        if len(table._versions()) > MOST_CHANGES:
            table.compact(sort_by)
        return days
    table = VersionedTable.create(new, path, key, sort_by, day)
    return [f.split("/")[0].split("=")[1] for f in table._day_folders()]
