"""Flight snapshots as a stream, with repeated state vectors removed.

Snapshots are landed files (one JSON snapshot per line), read with the file
source; the stream offset is the set of files, so a replay re-reads the
same snapshots.  A repeated vector (same ``icao24`` at the same snapshot
time) is dropped, whatever order the files arrive in:

* ``flight_stream`` keeps the keys seen in the state store
  (``dropDuplicates``).  ``delay`` bounds that state by a watermark, at the
  price of dropping snapshots that arrive later than it.
* ``write_states`` keeps no state: each micro-batch is compared with what
  earlier batches wrote, in the days of snapshot time it touches only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.sources import flights
from feedloom.streaming.log import BatchLog, run_id, written_parts
from feedloom.streaming.sources import text_lines

KEY = ["icao24", "time_ingest"]


def dedupe_states(states: DataFrame, delay: str | None = None) -> DataFrame:
    if delay is None:
        return states.dropDuplicates(KEY)
    return states.withWatermark("time_ingest", delay).dropDuplicatesWithinWatermark(KEY)


def state_rows(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Every vector of the landed snapshots, repeats included."""
    return flights.normalise(text_lines(spark, path, max_files_per_trigger))


def flight_stream(spark, path: str, delay: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    return dedupe_states(state_rows(spark, path, max_files_per_trigger), delay)


def write_states(states: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """Append each vector once to ``out`` (partitioned by batch and day).

    A micro-batch is named by its stream and number (``BatchLog``): a retried
    one is written once, and another checkpoint over the same output goes on
    behind what is there.  It is compared with the fragments of the days it
    touches, which the log lists.  The collected days are those of one
    micro-batch's snapshots.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run, log = run_id(spark, checkpoint), BatchLog(spark, out)
        seq = log.begin(run, batch_id)
        if seq is None:
            return
        day = F.date_format("time_ingest", "yyyyMMdd").cast("int")
        schema = batch.schema.toDDL()
        new = batch.dropDuplicates(KEY).withColumn("day", day).persist()
        try:
            days = [_folder(r[0]) for r in new.select("day").distinct().collect()]
            old, fresh = log.read(schema, days), new
            if old is not None:
                seen = (F.col("icao24") == F.col("_icao24")) & (F.col("time_ingest") == F.col("_time_ingest"))
                fresh = new.join(old.select(*[F.col(k).alias(f"_{k}") for k in KEY]), seen, "left_anti")
            # a few files a day, and a hot day split
            folder = f"batch_id={seq}"
            fresh.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{log.root}/{folder}")
            log.commit(run, batch_id, {p: f"{folder}/{n}" for p, n in written_parts(spark, f"{log.root}/{folder}").items()})
            log.merge(days, schema, "day")
        finally:
            new.unpersist()

    return (states.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _folder(day: int | None) -> str:
    """The value of a day's partition folder."""
    return "__HIVE_DEFAULT_PARTITION__" if day is None else str(day)
