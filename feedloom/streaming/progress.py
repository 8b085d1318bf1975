"""Progress of running queries by what they take in: valid records, not messages.

``observed`` counts the messages of each micro-batch while they pass, and ``Intake`` hears
of every micro-batch as it ends, so no long pause between looks can miss one.
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRIC = "intake"


def observed(parsed: DataFrame) -> DataFrame:
    """The parsed rows of a stream, counted as they pass. Each is to be used once a batch."""
    return parsed.observe(
        METRIC, F.count(F.lit(1)).alias("messages"), F.count_if(F.col("error").isNull()).alias("valid")
    )


@dataclass
class Taken:
    """What a run of a query has taken in so far."""

    began: float
    batches: int = 0
    messages: int = 0
    valid: int = 0
    last_valid_at: float | None = None
    #: (valid records, seconds since the begin, records a second) at each multiple passed.
    milestones: list[tuple[int, float, float | None]] = field(default_factory=list)

    def add(self, messages: int, valid: int, now: float, every: int) -> None:
        before = self.valid // every
        self.batches, self.messages, self.valid = self.batches + 1, self.messages + messages, self.valid + valid
        if valid:
            self.last_valid_at = now
        seconds = now - self.began
        if self.valid // every > before:
            rate = self.valid / seconds if seconds > 0 else None
            self.milestones.append((self.valid // every * every, seconds, rate))


class Intake(StreamingQueryListener):
    """Counts per run of a query; ``with Intake(...) as intake`` listens while it is open.

    A micro-batch that passes several multiples of ``every`` gives the last of them.
    """

    def __init__(self, spark, every: int = 100_000, clock=time.monotonic):
        if every < 1:
            raise ValueError("milestones must be at least one record apart")
        self.spark, self.every, self.clock = spark, every, clock
        self._runs: dict[str, Taken] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> Intake:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def of(self, run_id) -> Taken:
        with self._lock:
            return self._runs.setdefault(str(run_id), Taken(self.clock()))

    def onQueryStarted(self, event) -> None:
        self.of(event.runId)

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(METRIC)
        taken = self.of(event.progress.runId)
        with self._lock:
            # A batch without data counts nothing, and then has NULLs or no metric.
            counts = (seen["messages"] or 0, seen["valid"] or 0) if seen is not None else (0, 0)
            taken.add(*counts, self.clock(), self.every)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stop_when_idle(
    query: StreamingQuery, intake: Intake, idle_seconds: float, poll_seconds: float = 1.0
) -> None:
    """Stop a running query that has taken in no valid record for ``idle_seconds``.

    Malformed messages don't keep it running. A micro-batch that is under way may hold valid
    records, so it is waited for; if it had none, the query is stopped even if the next one
    has begun, as it would without end where malformed messages keep coming.
    """
    taken, late_at = intake.of(query.runId), None
    while query.isActive:
        since = taken.began if taken.last_valid_at is None else taken.last_valid_at
        if intake.clock() - since <= idle_seconds:
            late_at = None
        elif late_at is None and query.status["isTriggerActive"]:
            late_at = taken.batches
        elif late_at is None or taken.batches > late_at or not query.status["isTriggerActive"]:
            query.stop()
            return
        time.sleep(poll_seconds)
    if query.exception() is not None:
        raise query.exception()
