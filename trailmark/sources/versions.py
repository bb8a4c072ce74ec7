"""Tables in versions: a reader sees all of a commit or nothing of it.

A table is cut into parts (days, buckets).  Writing puts new files into a folder no version names yet, one sub-folder a part.
A commit lists, for every table and part, the folder that holds it, in one small file that appears by a
rename; the file with the highest number is the current version.  Until then nothing that a reader can reach has
changed, and after it the former version's files still stand, so a reader that has begun goes on undisturbed.
``vacuum`` removes what only old versions name.

The list grows with tables and parts, never with rows.  One writer a store; a second one's commit is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "part"
_VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another writer has committed since the version this commit builds on."""


@dataclass(frozen=True)
class Part:
    folder: str
    rows: int | None = None


@dataclass(frozen=True)
class Snapshot:
    """What one version holds: parts by table, and the writer's notes."""

    number: int = 0
    tables: Mapping[str, Mapping[str, Part]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)

    def parts(self, table: str) -> Mapping[str, Part]:
        return self.tables.get(table, {})

    def but(self, table: str, changes: Mapping[str, Part | None]) -> Snapshot:
        """With some parts of a table replaced, or removed where None."""
        merged = {p: v for p, v in {**self.parts(table), **changes}.items() if v is not None}
        return Snapshot(self.number, {**self.tables, table: merged}, self.notes)

    def noting(self, **notes: object) -> Snapshot:
        return Snapshot(self.number, self.tables, {**self.notes, **notes})


class VersionedTables:
    """The versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def names_above(self) -> list[str]:
        """What stands beside the store's own folder."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path("").getParent()))

    def remove_above(self, name: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path("").getParent(), name)
        self._fs.delete(path, True)

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names(_VERSIONS) if n.endswith(".json") and not n.startswith(".")]

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The current version, or an earlier one that has not been removed."""
        known = self.versions()
        if number is None:
            if not known:
                return Snapshot()
            number = known[-1]
        stream = self._fs.open(self._path(f"{_VERSIONS}/{number:012d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        body = json.loads(text)
        tables = {t: {p: Part(*v) for p, v in parts.items()} for t, parts in body["tables"].items()}
        return Snapshot(number, tables, body["notes"])

    def read(self, snapshot: Snapshot, table: str, schema: str | StructType, parts: Iterable[str] | None = None) -> DataFrame:
        """Rows of a table in a version, of some parts only if given; parts that are not there are empty."""
        held = snapshot.parts(table)
        wanted = held if parts is None else [p for p in parts if p in held]
        folders = sorted({f"{self.root}/{held[p].folder}" for p in wanted})
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def write(self, table: str, rows: DataFrame, files: int | None = 1, counted: Mapping[str, int] | None = None) -> dict[str, Part]:
        """Write rows with a ``part`` column into a new folder; returns the parts found in them.  No version names them yet.

        A part's rows are dealt over ``files`` tasks; with None every task writes the rows it has, which suits a single large part.
        """
        folder = f"{table}/{uuid.uuid4().hex}"
        others = [c for c in rows.columns if c != PART]
        dealt = rows if files is None else rows.repartition(PART, F.pmod(F.hash(*others[:2]), F.lit(files)))
        dealt.write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        found = [n.removeprefix(f"{PART}=") for n in self._names(folder) if n.startswith(f"{PART}=")]
        return {p: Part(f"{folder}/{PART}={p}", (counted or {}).get(p)) for p in found}

    def commit(self, snapshot: Snapshot) -> Snapshot:
        """Make ``snapshot``, built on version ``snapshot.number``, the current version."""
        known = self.versions()
        if (known[-1] if known else 0) != snapshot.number:
            raise Conflict(f"version {known[-1] if known else 0} is current, not {snapshot.number}")
        body = json.dumps({
            "tables": {t: {p: [v.folder, v.rows] for p, v in sorted(parts.items())} for t, parts in sorted(snapshot.tables.items()) if parts},
            "notes": dict(snapshot.notes),
        })
        number = snapshot.number + 1
        draft, final = self._path(f"{_VERSIONS}/.{uuid.uuid4().hex}"), self._path(f"{_VERSIONS}/{number:012d}.json")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise Conflict(f"version {number} is already there")
        return Snapshot(number, snapshot.tables, snapshot.notes)

    def vacuum(self, keep: int = 2) -> int:
        """Remove files and lists that none of the last ``keep`` versions names; returns how many folders went.

        Call it when no refresh is under way and no reader still uses an older version.
        """
        known = self.versions()
        kept = {v.folder for n in known[-keep:] for parts in self.snapshot(n).tables.values() for v in parts.values()}
        gone = 0
        for table in self._names(""):
            if table.startswith("_"):
                continue
            for written in self._names(table):
                mine = [f"{table}/{written}/{part}" for part in self._names(f"{table}/{written}") if part.startswith(PART)]
                stale = [f for f in mine if f not in kept]
                for f in [f"{table}/{written}"] if len(stale) == len(mine) else stale:
                    self._fs.delete(self._path(f), True)
                gone += len(stale)
        for n in known[:-keep]:
            self._fs.delete(self._path(f"{_VERSIONS}/{n:012d}.json"), False)
        for name in self._names(_VERSIONS):
            if name.startswith(".") and not name.endswith(".crc"):
                self._fs.delete(self._path(f"{_VERSIONS}/{name}"), False)
        return gone
