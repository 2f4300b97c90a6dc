"""File-source stream that drives the batch run once per micro-batch.

One query is one active run.  The checkpoint remembers which documents were consumed; a
batch that failed is offered again with the same id and files.  It keeps the instant of its
first attempt, every step it repeats is keyed, and what it has logged is not logged again, so
it changes nothing twice.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import insert_new
from ..plans.bikeshare import with_instant
from ..plans.medallion import Settings, Warehouse, check_freshness, run_batch
from ..schemas import DAMAGED_KEY
from ..sources.envelope import explode_payload, read_documents, sort_out, stream_documents
from ..sources.landing import LANDED_GLOB, latest_snapshot


def first_attempt(spark: SparkSession, checkpoint: str, batch_id: int) -> tuple[datetime, bool]:
    """When the batch was first offered, and whether it was before now.

    An empty file below the checkpoint marks the first attempt; its own time is the instant.
    The mark of the batch before is removed, as that one is committed.
    """
    def path(number: int):
        return spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/attempts/{number}")

    mark = path(batch_id)
    fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    repeated = not fs.createNewFile(mark)
    fs.delete(path(batch_id - 1), False)
    millis = fs.getFileStatus(mark).getModificationTime()
    return datetime.fromtimestamp(millis / 1000, timezone.utc), repeated


def elements(documents: DataFrame) -> DataFrame:
    """The envelope of whole documents; the instant is read once for each document."""
    return explode_payload(with_instant(documents), "payload", keep_empty=True)


def start_feed(wh: Warehouse, information_path: str, status_path: str, checkpoint: str,
               settings: Settings = Settings(), glob: str = LANDED_GLOB, latest_only: bool = False,
               max_files: int | None = None, interval: str | None = None,
               dead_letters: bool = False) -> StreamingQuery:
    """Start the stream over the status feed; stations come from the newest snapshot.

    Without ``interval`` all landed documents are consumed and the query ends
    (``availableNow``); with one, e.g. ``"5 minutes"``, it keeps polling.  ``latest_only``
    skips all but the newest document of a micro-batch.

    A damaged document fails its batch, again and again, until it is taken away.  With
    ``dead_letters`` it goes whole to ``wh.damaged``, with the reason, and the others of its batch
    go on; :func:`replay` reads it again once it is mended.
    """
    spark = wh.spark

    def consume(batch: DataFrame, batch_id: int) -> None:
        if latest_only:
            newest = batch.agg(F.max(F.struct("file_time", "file")).alias("m")).first().m
            if newest is None:
                return
            batch = batch.filter(F.col("file") == newest.file)
        information = elements(read_documents(spark, latest_snapshot(spark, information_path, glob), glob))
        at, wh.log.repeated = first_attempt(spark, checkpoint, batch_id)
        if dead_letters:
            batch, damaged = sort_out(batch)
            damaged = damaged.withColumn("found_at", F.lit(at))
            wh.damaged.append(insert_new(wh.damaged.colliding(damaged), damaged, DAMAGED_KEY))
        try:
            if not dead_letters or not batch.isEmpty():
                run_batch(wh, information, elements(batch), at, settings)
        finally:
            wh.log.repeated = False

    writer = (stream_documents(spark, status_path, glob, max_files)
              .writeStream.foreachBatch(consume).option("checkpointLocation", checkpoint))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def replay(wh: Warehouse, information: DataFrame, mended: DataFrame, at: datetime,
           settings: Settings = Settings()) -> None:
    """Run a batch over documents of ``wh.damaged`` whose ``payload`` has been mended.

    They keep their file and its time, so their readings get the instants that they were due;
    what is stored already stays as it is.
    """
    documents = mended.select("file", "file_time", "payload")
    run_batch(wh, information, elements(documents), at, settings)


def start_freshness(wh: Warehouse, checkpoint: str, interval: str = "5 minutes",
                    settings: Settings = Settings()) -> StreamingQuery:
    """Log the freshness of both feeds on a timer, whether or not anything arrives.

    The timer is Spark's rate source; each trigger judges what is stored at the newest tick.
    """
    def check(ticks: DataFrame, batch_id: int) -> None:
        now = ticks.agg(F.max("timestamp")).first()[0]
        if now is not None:
            check_freshness(wh, now.astimezone(timezone.utc), settings)

    timer = wh.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (timer.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())
