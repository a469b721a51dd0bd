"""The ingest ledger as a stored table: a snapshot of current states and the events since.

Events are appended to the newest segment. Folding makes a snapshot of the state of every file
from the last snapshot and the segments sealed since, so a read takes the snapshot and the few
segments after it, however long the history is.

A segment is folded one fold after it was sealed: an append that was under way when its segment
was sealed is seen as long as it ends before the next fold. States are events themselves and the
last one wins, so events that are appended twice, or come late and out of order, change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake.operators.ledger import current_state
from aerolake.plans.tables import child_names, drop_folders, make_folder
from aerolake.schemas import LEDGER


class LedgerTable:
    """Events of file states below ``path``; one fold may run at a time, appends at any time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _segments(self) -> list[int]:
        return _numbers(child_names(self.spark, f"{self.path}/events"), "segment")

    def _snapshots(self) -> list[int]:
        """First segments that a complete snapshot does not hold, in order."""
        found = _numbers(child_names(self.spark, f"{self.path}/states"), "before")
        return [n for n in found if "_SUCCESS" in child_names(self.spark, self._states(n))]

    def _states(self, before: int) -> str:
        return f"{self.path}/states/before={before}"

    def _events(self, segment: int) -> str:
        return f"{self.path}/events/segment={segment}"

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*folders)

    def append(self, events: DataFrame) -> None:
        """Add events to the newest segment."""
        newest = max([*self._segments(), *self._snapshots()], default=0)
        events.select(*LEDGER.names).write.mode("append").parquet(self._events(newest))

    def events(self) -> DataFrame:
        """The whole history, as far as it was not forgotten."""
        return self._read([self._events(n) for n in self._segments()])

    def _known(self, end: int | None = None) -> DataFrame:
        """The last snapshot, and events of later segments before ``end``."""
        held = self._snapshots()[-1:]
        first = held[0] if held else 0
        late = [n for n in self._segments() if n >= first and (end is None or n < end)]
        return self._read([*map(self._states, held), *map(self._events, late)])

    def current(self) -> DataFrame:
        """The last event of each file of each job."""
        return current_state(self._known())

    def fold(self) -> bool:
        """Fold the segments sealed before this call, then seal the newest; False if none was.

        The last snapshot but one goes; a reader that just opened the last one is not disturbed.
        """
        segments, snapshots = self._segments(), self._snapshots()
        newest = max([*segments, *snapshots], default=0)
        done = snapshots[-1] if snapshots else 0
        sealed = [n for n in segments if done <= n < newest]
        if sealed:
            current_state(self._known(newest)).write.mode("overwrite").parquet(self._states(newest))
            drop_folders(self.spark, map(self._states, snapshots[:-1]))
        if newest in segments:
            make_folder(self.spark, self._events(newest + 1))
        return bool(sealed)

    def forget(self) -> int:
        """Delete the events that the last snapshot but one holds too; returns the segments."""
        before = ([0, 0, *self._snapshots()])[-2]
        old = [n for n in self._segments() if n < before]
        drop_folders(self.spark, map(self._events, old))
        return len(old)


def _numbers(names: list[str], prefix: str) -> list[int]:
    values = [name.split("=", 1)[1] for name in names if name.startswith(f"{prefix}=")]
    return sorted(int(value) for value in values if value.isdigit())
