"""An extension: candidates that arrive as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from biblion.operators.papers import unseen


def first_seen_stream(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """The first row of each key; keys are forgotten once they are older than ``late``."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def anti_seen_batches(known: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], key: str, ordinal: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch keeps what the stored keys don't have yet."""

    def run(batch: DataFrame, number: int) -> None:
        write(unseen(batch, known(), key, ordinal), number)

    return run
