"""Claims of a month: of several runs that load it at the same time, one does.

A claim is the file with the highest number in its folder, made by ``create_file``, so that
of several runs one makes a number.  It holds the run and the time until which it counts.
A run may make the next number where there is none, where the last one was given back, or
where its time is over (its driver was lost).  Numbers only grow: a run that was slow finds
a higher number than its own, and must not put its rows in place.

The drivers' clocks should agree to minutes, a claim counts for hours.  One small file stays
for each month and pipeline.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from velomart.sources.replace import Folder, create_file, read_file

CLAIM_HOURS = 12.0


class ClaimLostError(RuntimeError):
    """Another run has taken over what this one claimed."""


class Claim:
    """The claim of ``name`` under ``root`` (shared storage)."""

    def __init__(self, spark: SparkSession, root: str, name: str, hours: float = CLAIM_HOURS):
        self.spark = spark
        self.folder = Folder(spark, f"{root.rstrip('/')}/{name}")
        self.hours = hours
        self.run = uuid.uuid4().hex
        self.number: int | None = None

    def take(self) -> bool:
        """True if this run has the claim now; False if another one has it."""
        last, holder = self._last()
        now = dt.datetime.now(dt.timezone.utc)
        if holder is not None and dt.datetime.fromisoformat(holder["until"]) > now:
            return False
        until = (now + dt.timedelta(hours=self.hours)).isoformat()
        if not self._make(last + 1, {"run": self.run, "until": until}):
            return False
        self.number = last + 1
        return True

    def held(self) -> bool:
        """Whether no other run has taken it since."""
        return self.number is not None and self._last()[0] == self.number

    def assert_held(self) -> None:
        if not self.held():
            raise ClaimLostError(f"another run has taken over {self.folder.path}")

    def release(self) -> None:
        """Gives it back, where this run still has it."""
        if self.held():
            self._make(self.number + 1, None)
        self.number = None

    def _make(self, number: int, holder: dict | None) -> bool:
        if not create_file(self.spark, self._file(number), json.dumps(holder)):
            return False
        for old in self._numbers():
            if old < number:
                self.folder.delete(self._file(old))
        return True

    def _last(self) -> tuple[int, dict | None]:
        """The highest number (0: none) and who holds it."""
        while numbers := self._numbers():
            try:
                return numbers[-1], json.loads(read_file(self.spark, self._file(numbers[-1])))
            except Exception:
                if self._numbers()[-1:] == numbers[-1:]:  # else a higher one has replaced it
                    raise
        return 0, None

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in self.folder.children() if n.isdigit())

    def _file(self, number: int) -> str:
        return f"{self.folder.path}/{number:010d}"


@contextmanager
def claimed(spark: SparkSession, root: str, name: str, hours: float = CLAIM_HOURS) -> Iterator[Claim | None]:
    """The claim while the block runs, or None where another run has it."""
    claim = Claim(spark, root, name, hours)
    if not claim.take():
        yield None
        return
    try:
        yield claim
    finally:
        claim.release()
