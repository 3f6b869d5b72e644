"""Streaming forms: monthly counts of findings, and greedy segments of a running call."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from callsift.shipping import ship


def monthly_counts(stream: DataFrame, stamp: str, keys: list[str], delay: str = "7 days") -> DataFrame:
    """Counts per month and key. Windows cannot span months, so the month is a grouping column
    next to a daily window that lets the watermark close state; sum the days to get a month."""
    rows = stream.withWatermark(stamp, delay).withColumn("month", F.date_format(stamp, "yyyy-MM"))
    return rows.groupBy(F.window(stamp, "1 day"), "month", *keys).agg(F.count("*").alias("n")).select(
        "month", F.col("window.start").alias("day"), *keys, "n"
    )


def streaming_segments(turns: DataFrame, cap: int) -> DataFrame:
    """``transcript_id, order, segment`` while turns arrive in order; state is one row per call.

    Reads ``transcript_id, order, tokens, shift``, as the batch fold does.
    """
    ship(turns.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ordinal, current, held = state.get if state.exists else (0, 0, 0)
        for frame in frames:
            frame = frame.sort_values("order")
            found = []
            for n, shift in zip(frame["tokens"], frame["shift"]):
                if held and (shift or current + n > cap):
                    ordinal, current, held = ordinal + 1, int(n), 1
                else:
                    current, held = current + int(n), held + 1
                found.append(ordinal)
            yield pd.DataFrame({"transcript_id": frame["transcript_id"], "order": frame["order"], "segment": found})
        state.update((ordinal, current, held))

    return turns.groupBy("transcript_id").applyInPandasWithState(
        step, "transcript_id string, order long, segment long", "ordinal long, current long, held long", "append", GroupStateTimeout.NoTimeout
    )
