"""Incremental ledger ingest with Structured Streaming.

* T1 ``block_stream``: new decoded block files as a stream (fixed schema, no
  inference). File arrival order is irrelevant: every order key carries the
  block number, so "latest" is decided by ledger position, never by arrival.
* T2 ``latest_order_stream``: stateful ``max_by`` per ``orderId`` over the
  order writes (state store; update or complete mode). The state holds every column it is
  given for every key, on the executors' disks (``state_on_disk``): a caller that wants positions gives it positions.
* T3 ``run_ingest``: ``foreachBatch`` sink that appends each micro-batch's
  per-key latest write to a log partitioned by batch id. A retried batch
  overwrites only its own partition (dynamic partition overwrite), so a
  replay after a failure is idempotent. ``current_state`` reads the log
  with the same keep-latest aggregation, and silver is derived from it with
  the batch functions. ``compact`` folds the log into a versioned state up to
  a batch, after which readers need the state and the rest of the log only.

The checkpoint location must be on shared storage on a cluster (it is an
argument; nothing here picks a machine-local folder).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import ledger, silver
from orderlake.schemas import BLOCK, RAW_ORDER
from orderlake.sources import versioned


def block_stream(spark: SparkSession, path: str, multi_line: bool = True,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of decoded block files under ``path``."""
    r = spark.readStream.schema(BLOCK).option("multiLine", multi_line)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def files_per_trigger(files: int, triggers: int) -> int:
    """``maxFilesPerTrigger`` by which ``files`` come in ``triggers`` triggers at most, however many they are.

    Every trigger touches the whole state (all its partitions, and what a compaction folds in), so triggers of a fixed
    number of files make the work grow with the square of a backlog.
    """
    return max(1, -(-files // triggers))


_STORE = "spark.sql.streaming.stateStore."
#: State on the executors' disks, with one bound on the memory of all stores of an executor.
STATE_STORE = {_STORE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               _STORE + "rocksdb.boundedMemoryUsage": "true", _STORE + "rocksdb.maxMemoryUsageMB": "400",
               _STORE + "rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started in here keeps its state in RocksDB: the default store holds every key on the heap.

    A store named by the session wins. A started query has settings of its own, so those of the session are put back at once.
    """
    named = spark.conf.get(_STORE + "providerClass", None)
    chosen = {k: v for k, v in STATE_STORE.items() if named is None and spark.conf.get(k, None) is None}
    for k, v in chosen.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in chosen:
            spark.conf.unset(k)


def latest_order_stream(writes: DataFrame) -> DataFrame:
    """Running latest write per order (stateful aggregation)."""
    return ledger.latest_order_values(writes)


def _append_batch(updates_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        latest = ledger.latest_order_values(batch)
        (latest.withColumn("batch_id", F.lit(batch_id).cast("long"))
               .write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic")
               .option("compression", "zstd")
               .partitionBy("batch_id")
               .parquet(updates_path))
    return write


def run_ingest(spark: SparkSession, blocks_path: str, updates_path: str, checkpoint_path: str,
               chaincode: str = "mycc", multi_line: bool = True, max_files_per_trigger: int | None = None,
               available_now: bool = True):
    """Blocks -> order writes -> per-batch latest -> append-only update log.

    Returns the started query (``available_now`` processes what is there and stops).
    """
    writes = ledger.order_writes(block_stream(spark, blocks_path, multi_line, max_files_per_trigger), chaincode)
    w = (writes.writeStream
               .foreachBatch(_append_batch(updates_path))
               .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _append_changes(updates_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(updates_path))
    return write


def run_latest(latest: DataFrame, updates_path: str, checkpoint_path: str):
    """T2 to storage: each trigger appends the keys whose latest row changed (update mode) as a partition
    of its own; a retried trigger replaces that partition. Returns the started query."""
    with state_on_disk(latest.sparkSession):
        return (latest.writeStream.outputMode("update").foreachBatch(_append_changes(updates_path))
                      .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())


def current_latest(spark: SparkSession, updates_path: str, key: str) -> DataFrame:
    """The last change of every key in the log of ``run_latest``."""
    return ledger.latest_per_key(spark.read.parquet(updates_path), key, ["batch_id"]).drop("batch_id")


#: Property of a state's version: the last batch of the log that it holds.
FOLDED = "folded_batch"


def _tail(spark: SparkSession, updates_path: str, after: int) -> DataFrame:
    return spark.read.parquet(updates_path).where(F.col("batch_id") > after)


def _folded(spark: SparkSession, state_root: str) -> int:
    state = versioned.open_version(spark, state_root)
    return state.properties[FOLDED] if state else -1


def compact(spark: SparkSession, updates_path: str, state_root: str, key: str, order: list[str], up_to: int | None = None,
            buckets: int = 16) -> int:
    """Fold the log's batches up to ``up_to`` (all, if not given) into the state of ``state_root``; the last batch folded.

    Only buckets with changed keys are written. The state's version says how far the log is folded in, so a compaction that
    failed, or runs twice, changes nothing; folded batches may be deleted once no reader has an older version open.
    """
    done = _folded(spark, state_root)
    tail = _tail(spark, updates_path, done)
    last = (tail if up_to is None else tail.where(F.col("batch_id") <= up_to)).agg(F.max("batch_id").alias("b")).first()["b"]
    if last is None:
        return done
    changes = tail.where(F.col("batch_id") <= last).drop("batch_id")
    versioned.upsert(changes, state_root, key, order, buckets, properties={FOLDED: int(last)})
    return int(last)


def compacted_latest(spark: SparkSession, updates_path: str, state_root: str, key: str, order: list[str]) -> DataFrame:
    """The latest row of every key: the state, and the batches of the log that are not in it yet."""
    state = versioned.open_version(spark, state_root)
    tail = _tail(spark, updates_path, state.properties[FOLDED] if state else -1).drop("batch_id")
    if state is None:
        return ledger.latest_per_key(tail, key, order)
    held = versioned.read(spark, state_root, state.number)
    return ledger.latest_per_key(held.unionByName(tail.select(*held.columns)), key, order)


def run_compacted(latest: DataFrame, updates_path: str, state_root: str, checkpoint_path: str, key: str, order: list[str], every: int = 4):
    """``run_latest`` whose log is folded into the state of ``state_root`` after every ``every`` triggers."""
    append = _append_changes(updates_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, batch_id)
        if (batch_id + 1) % every == 0:
            compact(batch.sparkSession, updates_path, state_root, key, order, batch_id)

    with state_on_disk(latest.sparkSession):
        return (latest.writeStream.outputMode("update").foreachBatch(write)
                      .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())


def current_state(spark: SparkSession, updates_path: str) -> DataFrame:
    """Latest order document per ``orderId`` over the whole update log (bronze shape)."""
    log = spark.read.parquet(updates_path).drop("batch_id")
    latest = ledger.latest_order_values(log)
    return latest.select(F.from_json("value", RAW_ORDER).alias("d")).select("d.*")


def current_silver(spark: SparkSession, updates_path: str) -> tuple[DataFrame, DataFrame]:
    """Silver header and items of the current state."""
    return silver.bronze_to_silver(current_state(spark, updates_path))
