"""Micro-batch jobs that carry state between batches.

State lives in versioned buckets of vehicles: a batch rewrites the buckets of its own vehicles only, and
a repeated batch reads what stood before it and overwrites its own version, so results are the same after
a restart. Work on a batch uses the batch operators, which split hot vehicles instead of handing one
vehicle to one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from roadbook import schemas
from roadbook.operators import alerts
from roadbook.operators.conform import align
from roadbook.plans import warehouse
from roadbook.session import scratch_path
from roadbook.sources import buckets, storage, tables

BatchJob = Callable[[DataFrame, int], None]

SAMPLE = schemas._table(
    vehicle_id="string", event_timestamp="timestamp_ntz", event_id="string", speed_kph="double"
)
BUFFERED = SAMPLE
# a sample that a late one may still follow or precede, its verdict, and the time from which its vehicle takes late ones
OPEN_SAMPLE = T.StructType([
    *SAMPLE, *schemas._table(prev_speed_kph="double", harsh_brake="boolean", open_from="timestamp_ntz")
])
VERDICT = T.StructType([
    *SAMPLE, *schemas._table(prev_speed_kph="double", harsh_brake="boolean", batch="bigint")
])
SAMPLE_KEY = ["vehicle_id", "event_timestamp", "event_id"]


def stream_harsh_brake(out: str, state: str, delay: str = "1 hour") -> BatchJob:
    """Harsh-brake flags across batches, for samples that come in any order within ``delay``.

    The samples of a vehicle's last ``delay`` of event time, and the one before them, are kept. A late
    sample is judged against the one it follows, and the one that follows it is judged again: its new
    verdict is written beside the old one. :func:`read_harsh_brake` gives the verdicts that hold, which
    are those of the batch operator over all samples. A sample that is later than ``delay`` gets no
    verdict (nulls) and changes none. A sample delivered again is passed over while it is kept, or is
    such a late one; its verdict stays. State grows with the samples of ``delay``, not with the stream.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        scratch = scratch_path(spark, "harsh-brake")
        try:
            samples = _written(align(batch, SAMPLE).dropDuplicates(SAMPLE_KEY), f"{scratch}/samples")
            mine = buckets.touched(samples, "vehicle_id")
            kept = buckets.read(spark, state, OPEN_SAMPLE, mine, below=batch_id + 1)
            opened = kept.groupBy("vehicle_id").agg(F.max("open_from").alias("open_from"))
            placed = samples.join(opened, "vehicle_id", "left").withColumn(
                "late", F.coalesce(F.col("event_timestamp") < F.col("open_from"), F.lit(False))
            )
            fresh = placed.where(~F.col("late")).join(kept.select(*SAMPLE_KEY), SAMPLE_KEY, "left_anti")
            # looked at more than once below, and would be joined anew each time
            known = _written(_with_verdict(fresh, None).unionByName(_with_verdict(kept, "harsh_brake")), f"{scratch}/known")
            judged = alerts.harsh_brake(known)
            # the sample before the open ones has lost its own predecessor, so its verdict is final
            final = F.col("known") & (F.col("event_timestamp") < F.col("open_from"))
            judged = _written(judged.withColumns({
                name: F.when(final, F.col(f"old.{name}")).otherwise(F.col(name)) for name in ("prev_speed_kph", "harsh_brake")
            }), f"{scratch}/judged")
            tables.replace_table(_verdicts(judged, placed, batch_id), out, version=batch_id + 1)
            buckets.write(_still_open(judged, delay), state, "vehicle_id", batch_id + 1)
        finally:
            storage.delete(spark, scratch)

    return on_batch


def _written(df: DataFrame, path: str) -> DataFrame:
    """A copy on shared storage: in as few tasks as its size needs, where a cached plan keeps all of a shuffle's."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_verdict(samples: DataFrame, flag: str | None) -> DataFrame:
    """Samples with the verdict they have (``known``) or none yet."""
    old = F.struct("prev_speed_kph", flag) if flag else F.lit(None).cast("struct<prev_speed_kph:double,harsh_brake:boolean>")
    return samples.select(*SAMPLE.names, "open_from", old.alias("old"), F.lit(flag is not None).alias("known"))


def _verdicts(judged: DataFrame, placed: DataFrame, batch_id: int) -> DataFrame:
    """Rows of a batch: first verdicts, changed verdicts, and nulls for what came too late."""
    same = F.struct("prev_speed_kph", "harsh_brake").eqNullSafe(F.col("old"))
    given = judged.where(~F.col("known") | ~same)
    late = placed.where("late").select(*SAMPLE.names)
    return align(given.drop("old"), VERDICT).unionByName(align(late, VERDICT)).withColumn("batch", F.lit(batch_id).cast("bigint"))


def _still_open(judged: DataFrame, delay: str) -> DataFrame:
    """Samples that a late one may still touch, and the one before them."""
    timed = judged.where(F.col("event_timestamp").isNotNull())
    newest = F.max("event_timestamp") - F.expr(f"INTERVAL {delay}")
    opens = timed.groupBy("vehicle_id").agg(F.greatest(F.max("open_from"), newest).alias("open_from"))
    aged = timed.drop("open_from").join(opens, "vehicle_id").select(*OPEN_SAMPLE.names)
    still = aged.where(F.col("event_timestamp") >= F.col("open_from"))
    whole = F.max_by(F.struct(*OPEN_SAMPLE.names[1:]), F.struct("event_timestamp", "event_id")).alias("last")
    # what no vehicle has before its open samples need not be joined to tell so
    newest_open = opens.agg(F.max("open_from").cast("string")).first()[0]
    old = timed.drop("open_from").where(F.col("event_timestamp") < F.lit(newest_open).cast("timestamp_ntz"))
    aged = old.join(opens, "vehicle_id").select(*OPEN_SAMPLE.names)
    before = aged.where(F.col("event_timestamp") < F.col("open_from")).groupBy("vehicle_id").agg(whole)
    return still.unionByName(before.select("vehicle_id", "last.*"))


def read_harsh_brake(spark: SparkSession, out: str) -> DataFrame:
    """The verdicts that hold: of each sample the newest one, or nulls where it has none."""
    rows = tables.read_versions(spark, out, VERDICT)
    newest = F.max_by(F.struct("speed_kph", "prev_speed_kph", "harsh_brake"), F.struct(F.col("harsh_brake").isNotNull(), "batch"))
    return rows.groupBy(*SAMPLE_KEY).agg(newest.alias("verdict")).select(*SAMPLE_KEY, "verdict.*")


def stream_replay_buffer(state: str, n: int = 30) -> BatchJob:
    """Keep the newest ``n`` samples of every vehicle. Read them with :func:`read_replay_buffer`."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, samples = batch.sparkSession, align(batch, BUFFERED).persist()
        try:
            mine = buckets.touched(samples, "vehicle_id")
            kept = buckets.read(spark, state, BUFFERED, mine, below=batch_id + 1)
            buffered = alerts.replay_buffer(kept.unionByName(samples).distinct(), n).drop("recency")
            buckets.write(buffered, state, "vehicle_id", batch_id + 1)
        finally:
            samples.unpersist()

    return on_batch


def read_replay_buffer(spark: SparkSession, state: str) -> DataFrame:
    return buckets.read(spark, state, BUFFERED)


def stream_refresh(root: str, fact: str = "fact_vehicle_telemetry") -> BatchJob:
    """Store new facts of a batch and recompute exactly the mart days they touch, late or not.

    Streams of several facts may share one root: each refreshes what any load has noted by then,
    and settles only that.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        warehouse.load_fact(spark, root, fact, align(batch, schemas.TABLES[fact]), on_conflict="ignore")
        warehouse.refresh_marts(spark, root)

    return on_batch
