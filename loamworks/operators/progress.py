"""Download progress: a driver-side reporter, and the same fold over an event table."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import Reporter

LOG_SECONDS = 2.0


def format_bytes(n: int) -> str:
    if n < 1024:
        return f"{n} B"
    for power, unit in ((4, "TiB"), (3, "GiB"), (2, "MiB"), (1, "KiB")):
        if n >= 1024**power:
            return f"{n / 1024**power:.1f} {unit}"
    raise AssertionError


class Progress(Reporter):
    """Counts events and logs a line now and then."""

    def __init__(self, clock=time.monotonic):  # noqa: ANN001
        self.clock, self.begun, self.logged = clock, clock(), float("-inf")
        self.run_bytes = self.downloaded = self.hits = self.total = self.size = self.own = 0

    def started(self, name: str, total: int, size: int) -> None:
        self.total, self.size, self.own = total, size, 0

    def advanced(self, size: int) -> None:
        self.run_bytes += size
        self.own += size
        if self.clock() - self.logged >= LOG_SECONDS:
            self.logged = self.clock()
            logging.getLogger(__name__).info(self.line())

    def finished(self, name: str) -> None:
        self.downloaded += 1

    def cached(self, name: str, total: int) -> None:
        self.total = total
        self.hits += 1

    def rate(self) -> float:
        seconds = self.clock() - self.begun
        return self.run_bytes / seconds if seconds > 0 else 0.0

    def line(self) -> str:
        percent = 100 * self.own // self.size if self.size else 0
        return f"{self.downloaded + self.hits}/{self.total} files, {percent}%, {format_bytes(self.run_bytes)}, {format_bytes(int(self.rate()))}/s"


def fold(events: DataFrame, *by: str) -> DataFrame:
    """One row, or one for each of by: run_bytes, downloaded, cached, total of events (seq, kind, name, total, bytes)."""
    return events.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "advanced", F.col("bytes"))), F.lit(0)).alias("run_bytes"),
        F.count_if(F.col("kind") == "finished").alias("downloaded"),
        F.count_if(F.col("kind") == "cached").alias("cached"),
        F.max_by("total", F.when(F.col("total").isNotNull(), F.col("seq"))).alias("total"),
    )
