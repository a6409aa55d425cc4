"""Streams: documents chunked as they arrive, and the cooldown of providers as state.

The batch and the stream run the same operators; a stream over a folder gives the chunks that a batch
over the same files gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.config import ChunkConfig
from quirelake.operators.chunk import chunk_markdown

COOLDOWN = "provider string, ts timestamp, event_id bigint, outcome string, asked boolean, cooldown_until timestamp"


def stream_documents(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """B2: parquet documents of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_chunks(docs: DataFrame, out: str, checkpoint: str, key: str = "doc_id", text: str = "markdown", config: ChunkConfig = ChunkConfig(), dead_letters: str | None = None):
    """A query that writes the chunks of each batch of documents; those without text go to ``dead_letters`` with a reason and don't stop the rest."""

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        good = batch.where(f"trim(coalesce({text}, '')) <> ''")
        chunk_markdown(good, key, text, config).withColumn("batch", F.lit(number)).write.mode("append").parquet(out)
        if dead_letters:
            batch.where(f"trim(coalesce({text}, '')) = ''").select(key, F.lit("no text").alias("reason"), F.lit(number).alias("batch")).write.mode("append").parquet(dead_letters)
        batch.unpersist()

    return docs.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cooldown(lookups: list[tuple], after: int, seconds: float, streak: int = 0, until: pd.Timestamp | None = None) -> tuple[list[tuple], int, pd.Timestamp | None]:
    """W18 over ordered lookups (ts, event_id, outcome): whether each is asked and the cooldown it starts; then the state.

    ``after`` lookups in a row that end in 429 start a cooldown, in which nothing is asked and nothing
    counts; any other outcome ends the row. ``after`` or ``seconds`` of 0 turn it off.
    """
    out = []
    for ts, event, outcome in lookups:
        if until is not None and ts < until:
            out.append((ts, event, outcome, False, None))
            continue
        until, started = None, None
        streak = streak + 1 if outcome == "429" else 0
        if after > 0 and seconds > 0 and streak >= after:
            streak, until = 0, ts + pd.Timedelta(seconds=seconds)
            started = until
        out.append((ts, event, outcome, True, started))
    return out, streak, until


def cooldown_batch(lookups: DataFrame, after: int = 3, seconds: float = 600.0) -> DataFrame:
    """W18 over a table (``provider``, ``ts``, ``event_id``, ``outcome``): ``asked`` and ``cooldown_until`` of each lookup.

    The state goes through each provider's lookups in order, batch by batch: rows are range-sorted by
    provider and time and read as a stream, so a provider's rows are never all in memory.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, streak, until = None, 0, None
        for batch in batches:
            rows = []
            for provider, ts, event, outcome in zip(*(c.to_pylist() for c in batch.columns)):
                if provider != now:
                    now, streak, until = provider, 0, None
                made, streak, until = cooldown([(pd.Timestamp(ts), event, outcome)], after, seconds, streak, until)
                rows.append((provider, *made[0]))
            columns = list(zip(*rows)) if rows else [()] * 6
            stamp = batch.schema.field(1).type
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], stamp), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.bool_()), pa.array(columns[5], stamp)], ["provider", "ts", "event_id", "outcome", "asked", "cooldown_until"])

    ordered = lookups.select(F.col("provider").cast("string"), F.col("ts").cast("timestamp"), F.col("event_id").cast("bigint"), F.col("outcome").cast("string")).where("ts IS NOT NULL")
    return ordered.repartition("provider").sortWithinPartitions("provider", "ts", "event_id").mapInArrow(run, COOLDOWN)


def cooldown_stream(lookups: DataFrame, after: int = 3, seconds: float = 600.0) -> DataFrame:
    """W18 as a stream: the same over arriving lookups, the streak and the cooldown kept as state by provider."""

    def step(key, frames, state):
        streak, until = state.get if state.exists else (0, None)
        until = pd.Timestamp(until, tz="UTC").tz_localize(None) if until else None
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        made, streak, until = cooldown(list(rows[["ts", "event_id", "outcome"]].itertuples(index=False, name=None)), after, seconds, streak, until)
        state.update((streak, until.value if until is not None else None))
        yield pd.DataFrame([(key[0], *m) for m in made], columns=["provider", "ts", "event_id", "outcome", "asked", "cooldown_until"])

    return lookups.groupBy("provider").applyInPandasWithState(step, COOLDOWN, "streak int, until bigint", "append", "NoTimeout")


