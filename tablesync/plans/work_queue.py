"""Many tables copied in pieces: longest first, what fails is tried again after a wait."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Piece:
    """A part of a job that can run beside its others, and about how many rows it handles."""

    rows: int
    run: Callable[[], None]


class Job(Protocol):
    """Work on one table: opened once, then its pieces in any order, then finished."""

    name: str
    rows: int  # a first guess, until the pieces say more

    def open(self) -> Sequence[Piece]: ...

    def finish(self) -> object: ...

    def fail(self, error: Exception) -> None: ...


@dataclass
class _Progress:
    """A job in the queue: what is left of it, how fast it went, and how it ended."""

    job: Job
    waiting: deque = field(default_factory=deque)  # (not before, piece or None to open, attempt)
    left: int = 0
    running: int = 0
    done_rows: int = 0
    seconds: float = 0.0
    outcome: object = None
    over: bool = False


class WorkQueue:
    """Runs jobs on a number of threads.

    The next piece is always of the job that is expected to need longest from
    now on: its rows left by its own speed so far, or by everyone's. So a large table is never
    left for the end, and when it is cut into pieces all threads share it. A
    piece that fails waits ``wait`` seconds, then twice and four times that, and is
    tried ``attempts`` times in all; meanwhile others run. A job fails when one of its pieces does.
    """

    def __init__(
        self, spark: SparkSession | None, workers: int = 8, attempts: int = 3, wait: float = 1.0,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.spark, self.workers, self.attempts, self.wait, self.clock = spark, workers, attempts, wait, clock
        self.changed = threading.Condition()
        self.all: list[_Progress] = []

    def run(self, jobs: Sequence[Job]) -> list[object]:
        """The result of every job, or the exception it ended with."""
        self.all = [_Progress(job, deque([(0.0, None, 1)]), job.rows) for job in jobs]
        target = self._work if self.spark is None else inheritable_thread_target(self.spark)(self._work)
        threads = [threading.Thread(target=target, daemon=True) for _ in range(max(1, min(self.workers, 4096)))]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
        return [progress.outcome for progress in self.all]

    def _speed(self, progress: _Progress) -> float:
        for some in ([progress], self.all):
            seconds, rows = sum(p.seconds for p in some), sum(p.done_rows for p in some)
            if seconds > 0 and rows > 0:
                return rows / seconds
        return 1.0

    def _next(self) -> tuple[_Progress, tuple] | float | None:
        """The next piece, or how long to wait for one, or None when all is over."""
        now, soonest = self.clock(), None
        best, most = None, -1.0
        for progress in self.all:
            if progress.over or not progress.waiting:
                continue
            ready = min(progress.waiting, key=lambda entry: entry[0])
            if ready[0] > now:
                soonest = ready[0] if soonest is None else min(soonest, ready[0])
                continue
            expected = progress.left / self._speed(progress)
            if expected > most:
                best, most = (progress, ready), expected
        if best:
            return best
        if all(p.over for p in self.all):
            return None
        return 0.5 if soonest is None else max(0.001, soonest - now)

    def _work(self) -> None:
        while True:
            with self.changed:
                found = self._next()
                while isinstance(found, float):
                    self.changed.wait(found)
                    found = self._next()
                if found is None:
                    self.changed.notify_all()
                    return
                progress, entry = found
                progress.waiting.remove(entry)
                progress.running += 1
            self._attempt(progress, *entry[1:])

    def _attempt(self, progress: _Progress, piece: Piece | None, attempt: int) -> None:
        began, pieces, error = self.clock(), None, None
        try:
            if self.spark is not None:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", progress.job.name)
            if piece is None:
                pieces = progress.job.open()
            else:
                piece.run()
        except Exception as caught:  # tried again, or the job's outcome
            error = caught
        with self.changed:
            progress.running -= 1
            if error is not None and attempt < self.attempts and not progress.over:
                later = self.clock() + self.wait * 2 ** (attempt - 1)
                progress.waiting.append((later, piece, attempt + 1))
            elif error is not None:
                progress.waiting.clear()
                progress.outcome = progress.outcome or error
            elif pieces is not None:
                progress.waiting.extend((0.0, p, 1) for p in pieces)
                progress.left = sum(p.rows for p in pieces)
            else:
                progress.left -= piece.rows
                progress.done_rows += piece.rows
                progress.seconds += self.clock() - began
            ending = not progress.waiting and not progress.running and not progress.over
            progress.running += ending  # no one else ends it
            self.changed.notify_all()
        if ending:
            self._end(progress)

    def _end(self, progress: _Progress) -> None:
        outcome = progress.outcome
        try:
            if outcome is None:
                outcome = progress.job.finish()
        except Exception as caught:
            outcome = caught
        if isinstance(outcome, Exception):
            try:
                progress.job.fail(outcome)
            except Exception:  # the first error is what counts
                pass
        with self.changed:
            progress.outcome, progress.over = outcome, True
            self.changed.notify_all()
