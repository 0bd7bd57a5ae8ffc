"""Structured Streaming forms of the batch operators that follow time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.grading import ladder
from calorgrid.functions.numeric import dot


def hot_sessions(stream: DataFrame, key: str, ts: str, value: str, hot: float, gap: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Stretches of hot readings of a key that lie closer than ``gap``; rows later than ``delay`` are dropped."""
    s = stream.withWatermark(ts, delay).where(F.col(value) >= hot)
    return s.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("length"), F.max(value).alias("peak")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "length", "peak")


def windowed(stream: DataFrame, key: str, ts: str, value: str, size: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Count, mean and maximum per key and tumbling or sliding window."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return stream.withWatermark(ts, delay).groupBy(key, w.alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("peak")).select(key, F.col("w.start").alias("start"), "n", "mean", "peak")


def graded(stream: DataFrame, rules: DataFrame, key: str, value: str, steps: tuple[str, str, str] = ("caution", "warn", "critical")) -> DataFrame:
    """Each reading with its grade by the rule of its key: a stateless join with a static rule table."""
    return stream.join(rules, key, "left").withColumn("verdict", ladder(F.col(value), [F.col(s) for s in steps]))


def matched(stream: DataFrame, bank: DataFrame, block: str, vector: str, least: float = 0.95) -> DataFrame:
    """Rows of a stream with the entries (``ident, descriptor``) of a static bank in the same block whose descriptor is similar
    (dot product over length) by ``least``: a stream-static join, the bank being read anew for each batch. Null and unlike
    long vectors match nothing."""
    b = bank.select(F.col(block).alias("_block"), F.col("ident"), F.col("descriptor"))
    alike = dot(F.col(vector), F.col("descriptor")) / F.size(vector)
    on = (F.col(block) == F.col("_block")) & (F.size(vector) == F.size("descriptor"))
    return stream.join(b, on).withColumn("score", alike).where(F.col("score") >= least).drop("_block", "descriptor")


def unseen(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """Rows whose key hasn't been seen within the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_counter(stream: DataFrame, key: str, order: str, value: str, hot: float) -> DataFrame:
    """``key, run, length``: successive hot rows of a key across batches; a run comes out when a cool row ends it.

    State is the open run of each key (start and length); rows of a batch are taken in order of ``order``."""
    kind = dict(stream.dtypes)[key]

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        start, length = state.get if state.exists else (0, 0)
        pdf = pd.concat(list(batches)).sort_values(order)
        out = []
        for o, v in zip(pdf[order], pdf[value], strict=True):
            if v >= hot:
                start, length = (int(o) if length == 0 else start), length + 1
            elif length:
                out.append((k[0], start, length))
                start, length = 0, 0
        state.update((int(start), int(length)))
        yield pd.DataFrame(out, columns=["key", "run", "length"])

    return stream.groupBy(key).applyInPandasWithState(step, f"key {kind}, run long, length long", "start long, length long", "append", "NoTimeout")


def into(stream: DataFrame, path: str, checkpoint: str, force_batch=None):
    """A running write of new rows to parquet, each file exactly once; ``force_batch`` may handle batches itself."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (w.foreachBatch(force_batch) if force_batch else w.format("parquet").option("path", path)).start()
