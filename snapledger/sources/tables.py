"""Tables on plain Parquet.

Spark cannot MERGE into Parquet or swap a directory atomically, so a table that is replaced
as a whole is kept as immutable versions: data is written to a new directory, checked there,
and becomes current when a marker file is created that is named by the version's number and
holds the directory's name.  A second writer of the same number finds the marker and fails.
Creation without overwriting is atomic on HDFS and local disks; on an object store it needs a
connector with conditional puts.  A writer that dies earlier leaves the current version
untouched, and a marker that it left empty counts as no version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import conform

#: How long data that has been superseded stays for readers that began before.
KEEP = timedelta(days=1)
#: Bytes of a file that is not worth packing.
FILE_BYTES = 128 << 20


class ConcurrentWrite(RuntimeError):
    """Another writer has committed the version that this one was about to."""


class Marker(NamedTuple):
    number: int
    time: datetime


class Folder:
    """A folder on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def fs(self):
        return self.at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs().exists(self.at())

    def names(self, *parts: str) -> list[str]:
        """Names of what lies in a folder, in order."""
        fs, folder = self.fs(), self.at(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def delete(self, *parts: str) -> None:
        self.fs().delete(self.at(*parts), True)


class Markers(Folder):
    """Numbered small files, each of which can be made once: to make it is to commit it."""

    def content(self, number: int) -> str:
        stream = self.fs().open(self.at(f"{number:08d}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def all(self) -> list[Marker]:
        """Oldest first."""
        fs = self.fs()
        if not self.exists():
            return []
        return sorted(Marker(int(s.getPath().getName()),
                             datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc))
                      for s in fs.listStatus(self.at()))

    def last(self) -> tuple[int, str] | None:
        """Number and content of the newest one that is not empty."""
        for marker in reversed(self.all()):
            if content := self.content(marker.number):
                return marker.number, content
        return None

    def commit(self, number: int, content: str) -> None:
        fs, name = self.fs(), f"{number:08d}"
        fs.mkdirs(self.at())
        taken = ConcurrentWrite(f"{self.path}: number {number} was committed meanwhile")
        if fs.exists(self.at(name)):
            raise taken
        try:
            stream = fs.create(self.at(name), False)
        except Py4JJavaError as error:
            raise taken from error
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()

    def remove(self, number: int) -> None:
        self.fs().delete(self.at(f"{number:08d}"), False)


class VersionedTable:
    """A table replaced as a whole by each write; readers see one complete version.

    A version stays readable for ``keep`` after another one has taken its place, however many
    follow: a reader that ends within that time never misses a file.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: timedelta = KEEP):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep
        self.folder, self.markers = Folder(spark, path), Markers(spark, f"{self.path}/_committed")

    def versions(self) -> list[str]:
        """Directories of the committed versions, oldest first."""
        return [c for m in self.markers.all() if (c := self.markers.content(m.number))]

    def current_path(self) -> str | None:
        """Where the current version lies; None before the first one."""
        last = self.markers.last()
        return f"{self.path}/{last[1]}" if last else None

    def read(self) -> DataFrame:
        """The current version; a table never written reads as empty."""
        path = self.current_path()
        if path is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path)

    def replace(self, df: DataFrame, sort: Sequence[str] = (),
                check: Callable[[DataFrame], None] | None = None) -> str:
        """Write ``df`` as a new version and make it current.  ``df`` may read this table.

        ``check`` gets what was written and raises if it must not be published; the current
        version then stays, and what was written is removed.
        """
        markers = self.markers.all()
        number = markers[-1].number + 1 if markers else 1
        version = f"v={number:08d}-{uuid.uuid4().hex[:8]}"
        typed = conform(df, self.schema)
        if sort:
            typed = typed.sortWithinPartitions(*sort)
        typed.write.parquet(f"{self.path}/{version}")
        try:
            if check is not None:
                check(self.spark.read.schema(self.schema).parquet(f"{self.path}/{version}"))
            self.markers.commit(number, version)
        except Exception:
            self.folder.delete(version)
            raise
        self._expire()
        return version

    def _expire(self) -> None:
        markers = self.markers.all()
        bound = datetime.now(timezone.utc) - self.keep
        for old, successor in zip(markers, markers[1:]):
            if successor.time < bound:
                content = self.markers.content(old.number)
                self.markers.remove(old.number)
                if content:
                    self.folder.delete(content)


class AppendTable:
    """An append-only table, partitioned by the calendar date of ``ts`` so that recent reads
    and duplicate checks touch few directories.

    Below a day lie packs.  Appends go to an even pack; :meth:`compact` copies days into the odd
    pack that follows, and a marker then says that the lower packs of those days count no
    longer.  They stay for ``keep``, so no reader misses a file; one that lists the table while
    days are copied does not see the new pack, one that lists it later sees nothing else.
    """

    DATE, PACK = "day", "pack"

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str,
                 keep: timedelta = KEEP):
        self.spark, self.path, self.schema, self.ts = spark, path.rstrip("/"), schema, ts
        self.folder, self.markers = Folder(spark, path), Markers(spark, f"{self.path}/_compacted")
        self.keep = keep

    def exists(self) -> bool:
        return self.folder.exists()

    def days(self) -> list[date]:
        """The days that have rows, oldest first; names of folders, nothing is read."""
        names = [n.split("=", 1)[1] for n in self.folder.names() if n.startswith(f"{self.DATE}=")]
        return [date.fromisoformat(n) for n in names]

    def _compacted(self) -> tuple[int, dict[str, int]]:
        """Number of compactions, and for compacted days the least pack that counts."""
        last = self.markers.last()
        return (last[0], json.loads(last[1])) if last else (0, {})

    def _live(self) -> Column:
        """Which partitions count, said in partition columns alone."""
        number, least = self._compacted()
        live = F.col(self.PACK) <= 2 * number
        if least:
            known = F.from_json(F.lit(json.dumps(least)), "map<string,int>")
            live &= F.col(self.PACK) >= F.coalesce(
                F.try_element_at(known, F.col(self.DATE).cast("string")), F.lit(0))
        return live

    def _stored(self) -> DataFrame:
        """All rows with the columns of their partition."""
        stored = T.StructType([*self.schema.fields, T.StructField(self.DATE, T.DateType()),
                               T.StructField(self.PACK, T.IntegerType())])
        return self.spark.read.schema(stored).parquet(self.path).filter(self._live())

    def read(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """All rows, or those of the days from ``since`` to ``until`` (other days pruned)."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        df = self._stored()
        if since is not None:
            df = df.filter(F.col(self.DATE) >= F.lit(since))
        if until is not None:
            df = df.filter(F.col(self.DATE) <= F.lit(until))
        return df.drop(self.DATE, self.PACK)

    def newest(self, size: int, where: Column | None = None) -> DataFrame:
        """Rows (for which ``where`` holds) of the newest days that together have ``size`` of them.

        Opens the newest day, then two, four and so on, until there are enough; all ``size``
        newest rows are among those returned, as every other row is of an older day.
        """
        days, back = self.days(), 1
        while True:
            rows = self.read(days[-back] if back < len(days) else None)
            rows = rows if where is None else rows.filter(where)
            if back >= len(days) or rows.limit(size).count() == size:
                return rows
            back *= 2

    def span_of(self, df: DataFrame) -> tuple[str, str] | None:
        """First and last instant of a batch, as text in the session zone: two values, whatever
        the batch's size; None for an empty one."""
        first, last = df.agg(F.min(self.ts).cast("string"), F.max(self.ts).cast("string")).first()
        return None if first is None else (first, last)

    def colliding(self, batch: DataFrame, span: tuple[str, str] | None = None) -> DataFrame:
        """The stored rows of the days that occur in ``batch``, between its first and last instant.

        The days of the batch, at most one row for each day of the calendar, are broadcast, and
        Spark prunes the table's partitions by them at run time: a straggler of last year opens
        its own day and not the year since.  ``span`` is the batch's, if known already.
        """
        span = span or self.span_of(batch)
        if span is None or not self.exists():
            return self.read().limit(0)
        first, last = (F.lit(t).cast(self.schema[self.ts].dataType) for t in span)
        # The bounds take nothing away, but Spark prunes by a side only where that is filtered.
        days = batch.select(F.to_date(self.ts).alias(self.DATE)).distinct().filter(
            F.col(self.DATE).between(F.lit(first_day(span)), F.lit(date.fromisoformat(span[1][:10]))))
        stored = self._stored().filter(F.col(self.ts).between(first, last))
        return stored.join(F.broadcast(days), self.DATE, "left_semi").drop(self.DATE, self.PACK)

    def append(self, df: DataFrame) -> int:
        """Returns the number of rows, observed while they are written."""
        return self._write(conform(df, self.schema).withColumn(self.DATE, F.to_date(self.ts)),
                           2 * self._compacted()[0])

    def _write(self, dated: DataFrame, pack: int) -> int:
        """One shuffle on the day lets AQE cut the output into files of the advisory size: no
        file per task and day, and no single task for a large day."""
        written = Observation()
        (dated.withColumn(self.PACK, F.lit(pack)).hint("rebalance", self.DATE)
         .observe(written, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").partitionBy(self.DATE, self.PACK).parquet(self.path))
        return written.get["rows"]

    def compact(self, before: date, file_bytes: int = FILE_BYTES) -> list[date]:
        """Pack the small files of the days before ``before``; returns the days packed.

        A day is packed if it has more files than its bytes fill.  To be called by the one
        writer of the table, between appends.  If it dies, nothing has changed for readers, and
        the next call removes what it left.
        """
        if not self.exists():
            return []
        number, least = self._compacted()
        self._expire(least)
        pack = 2 * number + 1
        for day in self.days():
            self.folder.delete(f"{self.DATE}={day}", f"{self.PACK}={pack}")
        files = (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .load(self.path).withColumn(self.DATE, F.col(self.DATE).cast("date"))
                 .filter(self._live() & (F.col(self.DATE) < F.lit(before))))
        small = files.groupBy(self.DATE).agg(
            F.count("*").alias("files"), F.ceil(F.sum("length") / file_bytes).alias("needed"))
        days = sorted(r[0] for r in small.filter("files > greatest(needed, 1)").select(self.DATE).collect())
        if not days:
            return []
        rows = self._stored().filter(F.col(self.DATE).isin(days))
        expected, written = rows.count(), self._write(rows, pack)
        if written != expected:
            raise ConcurrentWrite(f"{self.path}: {expected} rows became {written} while they were packed")
        self.markers.commit(number + 1, json.dumps({**least, **{str(d): pack for d in days}}))
        return days

    def _expire(self, least: dict[str, int]) -> None:
        """Remove packs that stopped counting longer than ``keep`` ago."""
        markers = self.markers.all()
        bound = datetime.now(timezone.utc) - self.keep
        fresh = {m.number for m in markers if m.time >= bound}
        for day, pack in least.items():
            if (pack + 1) // 2 not in fresh:
                for name in self.folder.names(f"{self.DATE}={day}"):
                    if name.startswith(f"{self.PACK}=") and int(name.split("=")[1]) < pack:
                        self.folder.delete(f"{self.DATE}={day}", name)
        for old in markers[:-1]:
            if old.number not in fresh:
                self.markers.remove(old.number)


def first_day(span: tuple[str, str]) -> date:
    return date.fromisoformat(span[0][:10])


def overwrite_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Replace the days that occur in ``df``; other days of the table stay as they are."""
    (df.hint("rebalance", day).write.mode("overwrite").partitionBy(day)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
