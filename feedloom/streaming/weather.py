"""Weather timelines as a stream with one mark per location (keyed state).

``applyInPandasWithState`` keeps, per (latitude, longitude), only the ISO
text of the newest entry delivered.  Each micro-batch emits the entries of
a location strictly after its mark and moves the mark to the newest entry
seen (an empty batch leaves it unchanged).  The state is kept by bucket of
locations, one short text per location: a call of the function costs
milliseconds, as much as thousands of rows, so calls must not grow with the
locations.  Rows of a location are processed by the task that owns its
bucket.  (A checkpoint with state by location is of another schema, which
Spark refuses.)
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from feedloom.sources import weather
from feedloom.streaming.log import BatchLog, run_id

MARKS = "latitude double, longitude double, mark string"
OUTPUT = "latitude double, longitude double, weather string, timestamp string"


BUCKETS = 1024  # of the state; a checkpoint holds for one number of them


def _place() -> Column:
    """A location's name: one text for each pair of coordinates that are equal as
    group keys (0.0 and -0.0 are, and nulls)."""
    return F.concat_ws(",", *[F.coalesce((F.col(c) + F.lit(0.0)).cast("string"), F.lit("null"))
                              for c in ("latitude", "longitude")])


def marked_entries(rows: DataFrame, initial_mark: str = weather.INITIAL_MARK) -> DataFrame:
    def step(key, batches, state):
        marks = json.loads(state.get[0]) if state.exists else {}
        newest = dict(marks)
        for pdf in batches:
            # chunk by chunk: a hot location never has all its rows in memory
            new = []
            for place, time in zip(pdf["place"].tolist(), pdf["timestamp"].tolist()):
                top = newest.setdefault(place, initial_mark)
                if isinstance(time, str) and time > top:
                    newest[place] = time
                new.append(isinstance(time, str) and time > marks.get(place, initial_mark))
            if any(new):
                yield pdf[new][["latitude", "longitude", "weather", "timestamp"]]
        state.update((json.dumps(newest),))

    placed = rows.select("latitude", "longitude", "weather", "timestamp", _place().alias("place"))
    return (placed.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(BUCKETS)).cast("int")).groupBy("bucket")
            .applyInPandasWithState(step, OUTPUT, "marks string", "append",
                                    GroupStateTimeout.NoTimeout))


def marks_by_batch(rows: DataFrame, out_path: str, marks_path: str, checkpoint: str,
                   initial_mark: str = weather.INITIAL_MARK, trigger: dict | None = None,
                   keep_versions: int = 2):
    """Per-location marks kept as a versioned table instead of keyed state.

    Each micro-batch (``foreachBatch``): rows are joined with the previous
    marks version (one row per location: broadcast when Spark measures it
    small, never a shuffle of the rows by location), entries after the mark
    are written as the batch's output partition, and the advanced marks
    (partial ``max`` per location) as the batch's marks version.  Each of
    the two tables has a log that names micro-batches by stream and number,
    so a replayed batch gives the same result and a new checkpoint over the
    same tables goes on with the marks that are there.  A location holding a third of all rows is no hotter than any
    other: no step groups its rows into one task.  Only the newest
    ``keep_versions`` marks versions are kept (enough for a retry).
    """
    def each(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        run, entries, marks = run_id(spark, checkpoint), BatchLog(spark, out_path), BatchLog(spark, marks_path)
        mark_seq = marks.begin(run, batch_id)
        if mark_seq is None:
            return
        versions = marks.fragments()
        if versions:
            prev = spark.read.schema(MARKS).parquet(versions[-1])
        else:
            prev = (batch_df.select("latitude", "longitude").distinct()
                    .select("latitude", "longitude", F.lit(initial_mark).alias("mark")))
        # The marks are committed last: until then a retry finds the version this batch began with.
        seq = entries.begin(run, batch_id)
        if seq is not None:
            weather.increment(batch_df, prev, initial_mark).write.mode("overwrite").parquet(f"{entries.root}/batch_id={seq}")
            entries.commit(run, batch_id, {"": f"batch_id={seq}"})
            entries.merge([""], batch_df.schema.toDDL())
        weather.advance_marks(batch_df, prev, initial_mark).write.mode("overwrite").parquet(f"{marks.root}/batch_id={mark_seq}")
        marks.commit(run, batch_id, {"": f"batch_id={mark_seq}"}, drop=versions[:len(versions) + 1 - keep_versions])

    w = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
