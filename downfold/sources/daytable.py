"""Tables of days that grow by small batches, with a log of commits.

::

    <path>/data/<day column>=2024-01-10/part=<name>/*.parquet
    <path>/log/000000000017.json

A batch is written into part folders of its own, one in each day it has rows for. It counts
once the log has a new version that names them; the version file appears under its name in
one step and never replaces another, so readers see a batch whole or not at all, and of two
writers at once one fails. When a day has ``FAN`` parts of a level, they are rewritten as one
part of the next level, and one log version swaps them. So a day has at most FAN - 1 parts a
level, however many batches came, and a row is rewritten once a level.

A version lists all parts with their days: a reader of some days opens these folders only.
"""

import json
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Collection, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

#: Parts of a level that are merged into one of the next.
FAN = 16
#: Readers of an older version keep its parts for so long; so many log files are kept.
GRACE_MS, LOGS = 3_600_000, 100


class CommitConflict(RuntimeError):
    """Another writer has committed to the table meanwhile."""


class Part(NamedTuple):
    day: str
    name: str
    level: int


class Version(NamedTuple):
    """What the table is after a commit. ``batches`` are ranges of committed batch ids, first and last included."""

    number: int = 0
    parts: tuple[Part, ...] = ()
    batches: tuple[tuple[int, int], ...] = ()
    dropped: tuple[tuple[int, str, str], ...] = ()

    def has(self, batch_id: int) -> bool:
        return any(first <= batch_id <= last for first, last in self.batches)

    def next_batch(self) -> int:
        return self.batches[-1][1] + 1 if self.batches else 0

    def with_batch(self, batch_id: int) -> tuple[tuple[int, int], ...]:
        out: list[tuple[int, int]] = []
        for first, last in sorted([*self.batches, (batch_id, batch_id)]):
            if out and first <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(out[-1][1], last))
            else:
                out.append((first, last))
        return tuple(out)


class _Files:
    """The few file operations that the log needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self.at(path).getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> dict[str, int]:
        """Names in a folder with the times they were last changed."""
        if not self._fs.exists(self.at(path)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(self.at(path))}

    def read(self, path: str) -> str:
        stream = self._fs.open(self.at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A file that appears whole; ``CommitConflict`` if there is one of that name."""
        aside = self.at(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self._context.rename(aside, self.at(path), self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as error:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in str(error):
                raise CommitConflict(path) from error
            raise

    def delete(self, path: str) -> None:
        self._fs.delete(self.at(path), True)


def _now_ms() -> int:
    return time.time_ns() // 1_000_000


class DayTable:
    """One table. ``merge`` turns the rows of several parts of a day into those of one."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        day: str,
        order: Sequence[str],
        merge: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        fan: int = FAN,
        grace_ms: int = GRACE_MS,
        clock: Callable[[], int] = _now_ms,
    ):
        self.spark, self.path, self.schema, self.day, self.order = spark, path.rstrip("/"), schema, day, list(order)
        self.merge_rows, self.fan, self.grace_ms, self.clock = merge, fan, grace_ms, clock
        self._files = _Files(spark, self.path)

    def version(self) -> Version:
        """The newest version; before any commit that of an empty table."""
        known = [name for name in self._files.names(f"{self.path}/log") if name.endswith(".json") and name[0] != "."]
        if not known:
            return Version()
        found = json.loads(self._files.read(f"{self.path}/log/{max(known)}"))
        return Version(
            found["number"],
            tuple(Part(*p) for p in found["parts"]),
            tuple((a, b) for a, b in found["batches"]),
            tuple((at, day, name) for at, day, name in found["dropped"]),
        )

    def commit(self, rows: DataFrame, batch_id: int | None = None, merge: bool = True) -> bool:
        """Add a batch; false, with nothing written, if a batch of this id has been added before.

        Without an id the batch takes the next one. Rows of the batch without a day are an
        error. Without ``merge`` the caller merges at a time of its own.
        """
        before = self.version()
        batch_id = before.next_batch() if batch_id is None else batch_id
        if before.has(batch_id):
            return False
        new = self._write(rows, f"b{batch_id}-{uuid.uuid4().hex[:8]}", 0)
        self._publish(before, before.parts + new, before.with_batch(batch_id))
        if merge:
            self.merge()
        return True

    def merge(self, least: int | None = None) -> int:
        """Merge days that have ``least`` (else ``fan``) parts of a level; returns the number of new parts."""
        least, made = least or self.fan, 0
        while True:
            before = self.version()
            tiers: dict[tuple[str, int], list[Part]] = defaultdict(list)
            for part in before.parts:
                tiers[part.day, part.level].append(part)
            due = {key: parts for key, parts in tiers.items() if len(parts) >= max(2, least)}
            if not due:
                return made
            old = {part for parts in due.values() for part in parts}
            name, new = f"m-{uuid.uuid4().hex[:8]}", ()
            # one write for all days of a level
            for level in sorted({level for _, level in due}):
                parts = [part for (_, at), some in due.items() for part in some if at == level]
                new += self._write(self.merge_rows(self._of(parts)), f"{name}-{level + 1}", level + 1)
            left = tuple(part for part in before.parts if part not in old)
            dropped = tuple((self.clock(), part.day, part.name) for part in sorted(old))
            self._publish(before, left + new, before.batches, before.dropped + dropped)
            made += len(new)

    def compact(self) -> None:
        """Leave one part a day."""
        while any(n > 1 for n in self.parts_by_day().values()):
            before = self.version()
            crowded = {day for day, n in self.parts_by_day().items() if n > 1}
            old = [part for part in before.parts if part.day in crowded]
            level = max(part.level for part in old) + 1
            new = self._write(self.merge_rows(self._of(old)), f"c-{uuid.uuid4().hex[:8]}", level)
            dropped = tuple((self.clock(), part.day, part.name) for part in old)
            left = tuple(part for part in before.parts if part.day not in crowded)
            self._publish(before, left + new, before.batches, before.dropped + dropped)

    def read(self, first_day: str | date | None = None, last_day: str | date | None = None) -> DataFrame:
        """The rows of the newest version from ``first_day`` to ``last_day``; other days are not listed."""
        low, high = (None if d is None else str(d) for d in (first_day, last_day))
        return self._of([p for p in self.version().parts if (low is None or p.day >= low) and (high is None or p.day <= high)])

    def read_days(self, days: Collection) -> DataFrame:
        """The rows of single days, or of single values of whatever the table is divided by."""
        wanted = {str(d) for d in days}
        return self._of([p for p in self.version().parts if p.day in wanted])

    def read_batch(self, batch_id: int) -> DataFrame:
        """What a batch added, as long as it has not been merged."""
        return self._of([p for p in self.version().parts if p.name.startswith(f"b{batch_id}-")])

    def parts_by_day(self) -> dict[str, int]:
        counts: dict[str, int] = defaultdict(int)
        for part in self.version().parts:
            counts[part.day] += 1
        return dict(counts)

    def remove_strays(self, older_than_ms: int = 86_400_000) -> int:
        """Delete folders of failed writes: old ones that neither are parts nor wait for their readers."""
        state = self.version()
        known = {(p.day, p.name) for p in state.parts} | {(day, name) for _, day, name in state.dropped}
        removed = 0
        for folder in self._files.names(f"{self.path}/data"):
            if not folder.startswith(f"{self.day}="):
                continue
            for part, changed in self._files.names(f"{self.path}/data/{folder}").items():
                key = (folder.partition("=")[2], part.partition("=")[2])
                if key not in known and changed <= self.clock() - older_than_ms:
                    self._files.delete(f"{self.path}/data/{folder}/{part}")
                    removed += 1
        return removed

    def _of(self, parts: Sequence[Part]) -> DataFrame:
        names = self.schema.fieldNames()
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/data/{self.day}={p.day}/part={p.name}" for p in parts]
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).select(*names)

    def _write(self, rows: DataFrame, name: str, level: int) -> tuple[Part, ...]:
        """The parts written. The rebalance hint splits days too large for one task and merges small ones."""
        seen, day = Observation(), F.col(self.day)
        (
            rows.select(*self.schema.fieldNames())
            .hint("rebalance", self.day)
            .observe(seen, F.collect_set(day).alias("days"), F.count_if(day.isNull()).alias("without"))
            .withColumn("part", F.lit(name))
            .sortWithinPartitions(self.day, "part", *self.order)
            .write.mode("append")
            .partitionBy(self.day, "part")
            .parquet(f"{self.path}/data")
        )
        if seen.get["without"]:
            raise ValueError(f"{seen.get['without']} rows have no {self.day}")
        return tuple(Part(str(d), name, level) for d in sorted(seen.get["days"]))

    def _publish(self, before: Version, parts, batches, dropped=None) -> None:
        dropped, gone = before.dropped if dropped is None else dropped, self.clock() - self.grace_ms
        kept = [d for d in dropped if d[0] > gone]
        number = before.number + 1
        document = {"number": number, "parts": sorted(parts), "batches": batches, "dropped": kept}
        self._files.create(f"{self.path}/log/{number:012d}.json", json.dumps(document))
        # what no reader can need any more goes after the new version stands
        for at, day, name in dropped:
            if at <= gone:
                self._files.delete(f"{self.path}/data/{self.day}={day}/part={name}")
        if number > LOGS:
            self._files.delete(f"{self.path}/log/{number - LOGS:012d}.json")
