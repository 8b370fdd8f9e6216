"""Streaming forms, an extension: first pages, windowed counts, and the latest state of each target."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType


def first_pages(pages: DataFrame, key: str = "url_key", time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark; state is dropped behind it."""
    return pages.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def status_counts(events: DataFrame, by: str = "status", time: str = "ts", late: str = "10 minutes", size: str = "5 minutes") -> DataFrame:
    """Counts of each status in tumbling windows."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("span"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("span.start").alias("start"), by, "n")


def latest(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The row of the greatest time for each key, by a partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(time, *[c for c in rest if c != time])).alias("row")).select(*keys, "row.*")


def latest_states(events: DataFrame, keys: list[str], time: str, late: str = "10 minutes", idle_ms: int = 3_600_000) -> DataFrame:
    """The latest row of each key as a stream: a row whenever a key's latest one changes, and a last one, ``closed``, when a key has been quiet.

    What is kept is one row a key. Rows that come late replace nothing that is newer, rows behind the watermark are passed over; equal times are told apart by the other
    columns, as ``latest`` does. A key is closed, and its state dropped, when the watermark is ``idle_ms`` beyond its latest row. Restarted from
    its checkpoint the stream goes on where it was. Output mode: update.
    """
    rest = [c for c in events.columns if c not in keys]
    of = events.schema
    out = StructType([*(of[k] for k in keys), *(of[c] for c in rest), StructField("closed", BooleanType())])
    kept = StructType([of[c] for c in rest])
    order = [rest.index(time), *(i for i, c in enumerate(rest) if c != time)]

    def rank(row: tuple) -> tuple:
        """Nulls first, as Spark compares."""
        return tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in order)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            row = state.get
            state.remove()
            yield pd.DataFrame([(*key, *row, True)], columns=out.names)
            return
        before = state.get if state.exists else None
        best = before
        for frame in frames:
            for row in frame[rest].itertuples(index=False, name=None):
                row = tuple(None if pd.isna(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row)
                if best is None or rank(row) > rank(best):
                    best = row
        state.update(best)
        state.setTimeoutTimestamp(max(int(pd.Timestamp(best[order[0]]).timestamp() * 1000) + idle_ms, state.getCurrentWatermarkMs() + 1))
        if best != before:
            yield pd.DataFrame([(*key, *best, False)], columns=out.names)

    return events.withWatermark(time, late).groupBy(*keys).applyInPandasWithState(step, out, kept, "update", GroupStateTimeout.EventTimeTimeout)


def upsert(read: Callable[[], DataFrame], write: Callable[[DataFrame], None], keys: list[str], time: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the stored rows and a batch, the latest of each key; running a batch twice changes nothing."""

    def apply(batch: DataFrame, _: int) -> None:
        write(latest(read().unionByName(batch, allowMissingColumns=True), keys, time))

    return apply


def resume(spark: SparkSession, folder: str, schema: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> int:
    """Run ``work`` on the Parquet files of ``folder`` that no earlier run has done, and append its rows to ``out``.

    What is done is kept in ``checkpoint``; a batch that failed is run again as a whole and takes the place of what it had written. Returns the number of batches of this run.
    """
    ran: list[int] = []

    def apply(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")
        ran.append(number)

    spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(ran)
