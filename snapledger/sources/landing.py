"""Landing raw documents and finding landed files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import stamp
from .tables import Folder

#: Files of a feed: fetched ones by name, and those that :func:`land` writes.
LANDED_GLOB = "*.{json,txt}"
#: Folders named by a date or stamp; of those the greatest name is the newest.
_DATED = re.compile(r"(?:\w+=)?\d{4}\D?\d{2}")


def land(df: DataFrame, path: str, feed: str, batch_ts: str, payload: str) -> None:
    """Append each raw document, unchanged, as one file below
    ``feed=<f>/day=<date>/batch_ts=<stamp>/``, where :func:`latest_file` finds it.

    ``feed``, ``batch_ts`` and ``payload`` are column names.  One record per file keeps every
    document whole for the multi-line reader.  The write is map-only.
    """
    (df.select(F.col(feed).alias("feed"), F.to_date(batch_ts).alias("day"),
               stamp(F.col(batch_ts)).alias("batch_ts"), F.col(payload).alias("value"))
     .write.mode("append").option("maxRecordsPerFile", 1).option("lineSep", "\n")
     .partitionBy("feed", "day", "batch_ts").text(path))


def landed_files(spark: SparkSession, path: str, glob: str = LANDED_GLOB) -> DataFrame:
    """``path, modificationTime`` of the files below ``path``; file contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(path).select("path", "modificationTime"))


def latest_file(spark: SparkSession, path: str, glob: str = LANDED_GLOB) -> str:
    """The newest file below ``path``; ties go to the greatest path.

    Folders that are named by a date or stamp are descended from the newest one, so a landing
    zone kept by day is listed along one branch, whatever its age.  Other folders, and the files
    beside them, compete by time.
    """
    found = _newest(Folder(spark, path), glob, [])
    if found is None:
        raise FileNotFoundError(f"no {glob} file below {path}")
    return found[1]


def latest_snapshot(spark: SparkSession, path: str, glob: str = LANDED_GLOB) -> str:
    """The newest file, or the ``batch_ts=`` folder that it lies in: :func:`land` may write a
    snapshot in several documents."""
    file = latest_file(spark, path, glob)
    folder = file.rsplit("/", 1)[0]
    return folder if folder.rsplit("/", 1)[-1].startswith("batch_ts=") else file


def _newest(folder: Folder, glob: str, listed: list[str]) -> tuple[int, str] | None:
    """Time and path of the newest file; ``listed`` gets the folders that were looked into."""
    fs, jvm = folder.fs(), folder.spark._jvm
    wanted = jvm.org.apache.hadoop.fs.GlobFilter(glob)
    if not folder.exists():
        return None
    listed.append(folder.path)
    statuses = list(fs.listStatus(folder.at()))
    files = [(s.getModificationTime(), s.getPath().toString()) for s in statuses
             if s.isFile() and not s.getPath().getName().startswith(("_", "."))
             and wanted.accept(s.getPath())]
    names = sorted((s.getPath().getName() for s in statuses if s.isDirectory()), reverse=True)
    names = [n for n in names if not n.startswith(("_", "."))]
    below = []
    for name in names:
        found = _newest(Folder(folder.spark, f"{folder.path}/{name}"), glob, listed)
        if found:
            below.append(found)
            if all(map(_DATED.match, names)):
                break
    return max(files + below, default=None)
