"""A path target whose appends are seen whole or not at all.

Every append writes its files to a folder of its own and then adds one entry to
a log beside them; only what the log names is read.  An append that fails, after
some of its tasks or after all of them, leaves files that nobody reads, so the
next cycle finds the mark where it was and loads exactly the rest.

Entries are numbered, and a number is given once: of two cycles that started from
the same state one adds its entry, and the other is told of the conflict.  An
entry also holds the rows and the first and last time of its files, counted while
they were written, so the high-water mark is read from the log alone.

The log needs a file system on which a rename fails if the name is taken, as
HDFS does.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pingzones.operators.shared_folder import create_text, list_names, path_exists, read_text, release
from pingzones.schema import OUTPUT_SCHEMA
from pingzones.sinks.targets import TIME, Conflict, Snapshot, Target, latest_time_of_files

# After so many entries the log is also written as one list.
ENTRIES_PER_LIST = 100
_DIGITS = 12


@dataclass(frozen=True)
class Batch:
    """Files of one append.  ``rows`` is None for files that came without figures."""

    folder: str
    rows: int | None = None
    first: str | None = None
    last: str | None = None
    # Stream and number of the batch, if it came from one.
    stream: str | None = None
    number: int | None = None


@dataclass
class State:
    """What a log says after ``version`` entries."""

    version: int = 0
    batches: list[Batch] = field(default_factory=list)
    # Last batch of each stream.
    streams: dict[str, int] = field(default_factory=dict)

    def follow(self, entry: dict) -> State:
        added = [Batch(**b) for b in entry["batches"]]
        kept = [] if entry["replaces"] else self.batches
        numbers = {b.stream: b.number for b in added if b.stream is not None}
        return State(self.version + 1, kept + added, self.streams | numbers)

    def holds(self, stream: str | None, number: int | None) -> bool:
        return stream is not None and self.streams.get(stream, -1) >= number


@dataclass
class LoggedTarget(Target):
    """Parquet files under ``path``: batches in ``data``, the log in ``_log``."""

    spark: SparkSession
    path: str
    schema: object = OUTPUT_SCHEMA
    time: str = TIME

    @property
    def _log(self) -> str:
        return f"{self.path}/_log"

    def state(self) -> State:
        """The state now: the last full list and the entries after it."""
        names = set(list_names(self.spark, self._log))
        lists = sorted(n for n in names if n.endswith(".list"))
        state = State()
        if lists:
            whole = json.loads(read_text(self.spark, f"{self._log}/{lists[-1]}"))
            state = State(whole["version"], [Batch(**b) for b in whole["batches"]], whole["streams"])
        while (name := f"{state.version + 1:0{_DIGITS}}.json") in names:
            state = state.follow(json.loads(read_text(self.spark, f"{self._log}/{name}")))
        return state

    def exists(self) -> bool:
        return path_exists(self.spark, self._log)

    def read(self) -> DataFrame:
        return self._files(self.state().batches)

    def _files(self, batches: list[Batch]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[b.folder for b in batches])

    def high_water_mark(self) -> datetime | None:
        return self.mark_of(self.state())

    def mark_of(self, state: State) -> datetime | None:
        """Latest time of a state.  Files are looked into only where their figures are missing."""
        told = [datetime.fromisoformat(b.last) for b in state.batches if b.last]
        untold = [b for b in state.batches if b.rows is None]
        if untold:
            told.append(latest_time_of_files(self._files(untold), self.time).first()["max_ts"])
        return max((t for t in told if t is not None), default=None)

    def snapshot(self) -> Snapshot:
        state = self.state()
        return _LoggedSnapshot(self, self.mark_of(state), state)

    def staged(self, df: DataFrame, stream: str | None = None, number: int | None = None) -> Batch:
        """Files that no log entry names yet."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        seen = Observation()
        moment = lambda of: of(F.col(f"`{self.time}`")).cast("string")
        df.observe(
            seen, F.count(F.lit(1)).alias("rows"), moment(F.min).alias("first"), moment(F.max).alias("last")
        ).write.parquet(folder)
        figures = seen.get
        return Batch(folder, figures["rows"], figures["first"], figures["last"], stream, number)

    def _add(self, state: State, batches: list[Batch], replaces: bool) -> State:
        """The state with one entry more; Conflict if its number is taken."""
        entry = {"replaces": replaces, "batches": [vars(b) for b in batches]}
        name = f"{self._log}/{state.version + 1:0{_DIGITS}}"
        if not create_text(self.spark, f"{name}.json", json.dumps(entry)):
            raise Conflict(f"{self.path} has changed since entry {state.version}")
        after = state.follow(entry)
        if after.version % ENTRIES_PER_LIST == 0:
            whole = {"version": after.version, "batches": [vars(b) for b in after.batches], "streams": after.streams}
            create_text(self.spark, f"{name}.list", json.dumps(whole))
        return after

    def append(self, df: DataFrame, after: State | None = None) -> None:
        """Append a batch.

        ``after`` is the state that the rows were chosen by: if the log has gone on
        since, nothing is appended and Conflict is raised.  Without it the batch
        is appended to whatever is there.
        """
        self._append(df, after)

    def append_once(self, df: DataFrame, stream: str, number: int) -> bool:
        if self.state().holds(stream, number):
            return False
        self._append(df, None, stream, number)
        return True

    def _append(self, df: DataFrame, after: State | None, stream: str | None = None, number: int | None = None) -> None:
        batch = self.staged(df, stream, number)
        if batch.rows == 0:
            release(self.spark, batch.folder)
            return
        state = after or self.state()
        while not state.holds(stream, number):
            try:
                self._add(state, [batch], replaces=False)
                return
            except Conflict:
                if after is not None:
                    release(self.spark, batch.folder)
                    raise
                state = self.state()
        release(self.spark, batch.folder)

    def replace(self, df: DataFrame) -> None:
        """Put ``df`` in place of all rows: readers see the old ones until the new ones are complete.

        ``df`` may read this target.  If the log goes on meanwhile, nothing is
        replaced and Conflict is raised.
        """
        state = self.state()
        batch = self.staged(df)
        try:
            self._add(state, [batch], replaces=True)
        except Conflict:
            release(self.spark, batch.folder)
            raise

    def adopt(self, folder: str) -> None:
        """Count the Parquet files of ``folder``, which stay where they are, as a batch without figures."""
        self._add(self.state(), [Batch(folder)], replaces=False)

    def tidy(self) -> list[str]:
        """Delete the folders that the log does not name; returns them.

        To be called while nobody appends, as a batch being written is not named yet.
        """
        named = {b.folder for b in self.state().batches}
        data = f"{self.path}/data"
        left = [f"{data}/{n}" for n in list_names(self.spark, data) if f"{data}/{n}" not in named]
        for folder in left:
            release(self.spark, folder)
        return left


@dataclass
class _LoggedSnapshot(Snapshot):
    state: State

    def append(self, df: DataFrame) -> None:
        self.target.append(df, after=self.state)
