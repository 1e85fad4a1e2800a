"""Streaming sinks and runners.

Every query has its own checkpoint folder, outside the table it writes.  The file
sink's commit log and the checkpointed source offsets make a restarted query process
each input once; the object branch is idempotent because object names are keys.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyarrow.fs import FileType
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeframe.operators.frames import latest_rows, position_order
from lakeframe.session import rocksdb_state
from lakeframe.sinks.objects import Places, qualify, resolve_fs, write_objects


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger is None:
        return writer
    return writer.trigger(processingTime=trigger)


def append_stream(df: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet",
                  trigger: str | None = "availableNow", name: str | None = None,
                  partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append a stream to a table folder (K1 with ``fmt="delta"`` when installed, K2 parquet).
    State, if the query has any, is kept in RocksDB."""
    if checkpoint.rstrip("/").startswith(path.rstrip("/") + "/"):
        raise ValueError("checkpoint must not sit inside the table folder")
    writer = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    with rocksdb_state(df.sparkSession):
        return _trigger(writer, trigger).start(path)


def run_id(spark, checkpoint: str) -> str:
    """The id a query keeps in its checkpoint: the same after a restart, new with a new one."""
    return json.loads("".join(r[0] for r in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]


def object_stream(df: DataFrame, root: str, checkpoint: str, *, name: str = "media_name",
                  content: str = "image_data", order: tuple[str, str, str] = ("timestamp", "partition", "offset"),
                  metadata: tuple[str, ...] = (), sidecar: str | None = None, rejected: str | None = None,
                  places: str | None = None, trigger: str | None = "availableNow") -> StreamingQuery:
    """Stream records to objects named by ``name``.

    Each micro-batch is read once (persisted while it is written) and keeps the last record per
    name by ``order`` (A3).  Its objects are all written aside before any is moved into place, so a
    batch that fails half-way shows none; a replayed batch finishes the moves.  ``places``
    (default: ``<root>.places``) keeps the position each object was written from, in one manifest
    a batch, so an older record in a later batch replaces nothing.  The user metadata of each object (``metadata`` columns as
    a ``map<string,string>``) goes to ``sidecar`` and records without a name or content to
    ``rejected`` with a reason, both one folder per checkpoint and batch, overwritten on
    replay.  Without ``rejected`` such a record fails the query.
    """
    places = places or f"{root.rstrip('/')}.places"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"run_id={run_id(spark, checkpoint)}/batch_id={batch_id}"
        batch = batch.select(name, content, *order, *(m for m in metadata if m not in (name, content, *order))).persist()
        try:
            whole = F.col(name).isNotNull() & (F.col(name) != "") & F.col(content).isNotNull()
            whole = F.coalesce(whole, F.lit(False))
            if rejected:
                reason = F.when(F.col(content).isNull(), F.lit("null_payload")).otherwise(F.lit("missing_name"))
                (batch.where(~whole).select(F.col(name).alias("name"), *order, reason.alias("reason"))
                 .write.mode("overwrite").parquet(f"{rejected}/{folder}"))
                batch_rows = batch.where(whole)
            else:
                batch_rows = batch
            latest = latest_rows(batch_rows, name, order).withColumn("__write", position_order(*order, fields=dict(batch.dtypes)))
            write_objects(latest, root, name, content, "__write", Places(spark, places), folder)
            if sidecar and metadata:
                meta = F.create_map(*[x for m in metadata for x in (F.lit(m), F.col(m).cast("string"))])
                (latest.select(F.col(name).alias("name"), F.col("__write").alias("place"), meta.alias("metadata"))
                 .write.mode("overwrite").parquet(f"{sidecar}/{folder}"))
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def batch_table(path: str) -> Callable[[DataFrame, str], None]:
    """A sink for :func:`fan_out_batches`: appends to a table, a folder per query and batch, which a
    repeated attempt overwrites."""
    return lambda batch, folder: batch.write.mode("overwrite").parquet(f"{path}/{folder}")


def fan_out_batches(df: DataFrame, checkpoint: str, sinks: dict[str, Callable[[DataFrame, str], None]], ledger: str,
                    trigger: str | None = "availableNow") -> StreamingQuery:
    """One source read, several sinks (K13, T4): each micro-batch is persisted once and handed to
    every sink as ``sink(batch, folder)``, then released.

    ``ledger`` has an empty file per (query, batch, sink), written when that sink is done and looked
    up before it begins.  So if a sink fails, the replayed batch goes to it and to those after it, not
    to those before.  ``folder`` names query and batch: a sink that overwrites it repeats nothing
    where the failure came between its write and the ledger."""
    spark = df.sparkSession
    fs, base = resolve_fs(qualify(spark, ledger))

    def done(folder: str, name: str) -> str:
        return f"{base}/{folder}/sink={name}"

    def each(batch: DataFrame, batch_id: int) -> None:
        folder = f"run_id={run_id(spark, checkpoint)}/batch_id={batch_id}"
        open_sinks = {n: s for n, s in sinks.items() if fs.get_file_info(done(folder, n)).type == FileType.NotFound}
        if not open_sinks:
            return
        batch.persist()
        try:
            for name, sink in open_sinks.items():
                sink(batch, folder)
                fs.create_dir(f"{base}/{folder}", recursive=True)
                fs.open_output_stream(done(folder, name)).close()
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


# Called with each query that has ended in ``await_all``, e.g. to record its last plan.
ON_END: list[Callable[[StreamingQuery], None]] = []


def await_all(queries: list[StreamingQuery], timeout_s: float | None = None, poll_s: float = 0.2) -> None:
    """Wait until every query has ended (T6).  The first failure, in whichever query, surfaces
    within ``poll_s`` or so and stops the others.  With ``timeout_s``, queries still running
    after it are stopped and reported."""
    end = None if timeout_s is None else time.monotonic() + timeout_s
    running = list(queries)

    def stop_all() -> None:
        for q in queries:
            q.stop()

    while running:
        for q in list(running):
            try:
                if q.awaitTermination(poll_s / len(running)):
                    running.remove(q)
                    if q.exception() is not None:
                        raise q.exception()
                    for hook in ON_END:
                        hook(q)
            except StreamingQueryException as e:
                stop_all()
                raise RuntimeError(f"streaming query {q.name or q.id} failed: {e}") from e
        if running and end is not None and time.monotonic() > end:
            names = [str(q.name or q.id) for q in running]
            stop_all()
            raise TimeoutError(f"streaming queries still running after {timeout_s}s: {', '.join(names)}")
