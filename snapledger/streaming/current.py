"""Latest row per key as a stateful stream: the state is one row per key, the history is never read.

The aggregation runs in update mode: a trigger hands on the keys that it has changed, and they are
merged into the current table.  Order is by event time, so a row that arrives late changes nothing
unless it is newer than what is known, however late it is; there is no watermark, as state is
bounded by the number of keys and not by time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import upsert
from ..plans.bikeshare import STATUS_COLUMNS, build_current, file_instant, typed_readings
from ..plans.medallion import Warehouse
from ..quality.contract import verify
from ..schemas import CURRENT_CONTRACT, READING_COUNTS
from ..sources.envelope import entity_columns, explode_payload, stream_documents
from ..sources.landing import LANDED_GLOB
from ..sources.tables import VersionedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_state(stream: DataFrame, keys: Sequence[str], ts: str, first: Sequence[str] = ()) -> DataFrame:
    """One row per key of a stream: that with the greatest ``ts``, of equals the one whose columns
    ``first`` are the smallest.  Rows with a null key or instant are none of them."""
    others = [c for c in stream.columns if c not in keys]
    order = F.struct((-F.unix_micros(F.col(ts).cast("timestamp"))).alias("age"), *first)
    newest = stream.dropna(subset=[*keys, ts]).groupBy(*keys).agg(
        F.min_by(F.struct(*others), order).alias("newest"))
    return newest.select(*keys, *[F.col(f"newest.{c}").alias(c) for c in others])


def start_latest(state: DataFrame, table: VersionedTable, keys: Sequence[str], checkpoint: str,
                 finish: Callable[[DataFrame], DataFrame] = lambda df: df,
                 check: Callable[[DataFrame], None] | None = None,
                 interval: str | None = None) -> StreamingQuery:
    """Merge what each trigger has changed of ``state`` into ``table``.

    The keys of a repeated batch are merged again with the same rows, which changes nothing.
    """
    state.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def merge(changed: DataFrame, batch_id: int) -> None:
        table.replace(upsert(table.read(), finish(changed), keys), check=check)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (state.writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_current(wh: Warehouse, status_path: str, checkpoint: str, glob: str = LANDED_GLOB,
                  max_files: int | None = None, interval: str | None = None) -> StreamingQuery:
    """The current table of a warehouse from the status feed alone, beside its stations.

    Readings are typed as in the batch run.  Nothing is gated here: use it where the newest state
    is wanted at once and :func:`~snapledger.streaming.feed.start_feed` keeps the history.
    """
    documents = stream_documents(wh.spark, status_path, glob, max_files)
    elements = entity_columns(explode_payload(documents, "payload"), STATUS_COLUMNS)
    readings = typed_readings(elements, file_instant())
    state = latest_state(readings.select("id_station", "date_collecte", *READING_COUNTS, "file", "pos"),
                         ["id_station"], "date_collecte", first=["file", "pos"])

    def finish(changed: DataFrame) -> DataFrame:
        return build_current(changed, wh.station.read())

    return start_latest(state, wh.current, ["id_station"], checkpoint, finish,
                        lambda written: verify(written, CURRENT_CONTRACT), interval)
