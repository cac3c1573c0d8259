"""Derived tables that change together: new folders beside the old ones, then one small object that names the current ones.

A *draft* writes the groups it changes (or a whole table) to run folders of their own and never touches a
folder that a reader may be using.  ``commit`` writes one version object: for every table, which group is read
from which run folder.  The greatest version object is the current one, so all tables of a lake step from one
consistent state to the next at once; a job stopped at any write leaves readers where they were, and its folders
are garbage that ``expire`` removes.

A version object is put in place by a rename that fails if it is there already, so of two drafts on the same
version one commits and the other raises ``Conflict``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.sources import fs
from tidewater.sources.tables import Table, escape

#: Versions whose folders stay for readers that still use them.
KEEP_VERSIONS = 3
WHOLE = ""  # the one group of a table without partitions


class Conflict(RuntimeError):
    """Another draft was committed on the same version first."""


@dataclass
class State:
    """What one version object says: table -> run folder -> (groups read from it, how many were written to it)."""

    number: int = 0
    tables: dict[str, dict[str, dict]] = field(default_factory=dict)

    def groups(self, table: str) -> dict[str, str]:
        """Group -> run folder."""
        return {g: run for run, held in self.tables.get(table, {}).items() for g in held["groups"]}

    def folders(self, table: str, wanted: set[str] | None = None) -> list[str]:
        """Folders that hold these groups (all by default), a run's folder where all of it is current."""
        out = []
        for run, held in self.tables.get(table, {}).items():
            groups = held["groups"] if wanted is None else [g for g in held["groups"] if g in wanted]
            if groups and len(groups) == held["written"]:
                out.append(run)
            else:
                out += [f"{run}/{g}" for g in groups]
        return out


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _names(self) -> list[str]:
        return sorted(n for n in fs.names(self.spark, self.path) if n.startswith("v") and n.endswith(".json"))

    def _load(self, name: str) -> State:
        found = json.loads(fs.read_text(self.spark, f"{self.path}/{name}"))
        return State(found["number"], found["tables"])

    def current(self) -> State:
        names = self._names()
        return self._load(names[-1]) if names else State()

    def begin(self) -> Draft:
        return Draft(self)

    def put(self, state: State) -> None:
        text = json.dumps({"number": state.number, "tables": state.tables})
        if not fs.put_if_absent(self.spark, f"{self.path}/v{state.number:012d}.json", text):
            raise Conflict(f"version {state.number} is there already")

    def expire(self, tables: list[VersionedTable], keep: int = KEEP_VERSIONS) -> int:
        """Remove version objects but the last ``keep``, and the folders that no kept one names; how many went.

        Run folders numbered beyond the current version belong to a draft under way and stay.
        """
        names = self._names()
        kept = [self._load(n) for n in names[-keep:]]
        gone = 0
        for n in names[:-keep]:
            fs.delete(self.spark, f"{self.path}/{n}")
        last = kept[-1].number if kept else 0
        for table in tables:
            for run in fs.names(self.spark, table.path):
                if not run.startswith("_run=") or int(run.split("=")[1].split("-")[0]) > last:
                    continue
                used = {g for s in kept for g in s.tables.get(table.name, {}).get(run, {"groups": []})["groups"]}
                there = {*partition_folders(self.spark, f"{table.path}/{run}", len(table.partition_by))}
                if not used:
                    fs.delete(self.spark, f"{table.path}/{run}")
                    gone += 1
                for group in there - used if used else ():
                    fs.delete(self.spark, f"{table.path}/{run}/{group}")
                    gone += 1
        return gone


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below a run folder, ``depth`` levels down (one, '', for a table without partitions)."""
    found = [WHOLE]
    for _ in range(depth):
        found = [f"{g}/{n}" if g else n for g in found for n in fs.names(spark, f"{path}/{g}" if g else path) if "=" in n]
    return found


class VersionedTable(Table):
    """A derived table whose current folders the lake's versions name; its groups are its partition values."""

    def __init__(self, versions: Versions, name: str, path: str, schema: str, **how):
        super().__init__(versions.spark, path, schema, **how)
        self.versions, self.name = versions, name

    def group(self, values: tuple) -> str:
        return "/".join(f"{c}={escape(x)}" for c, x in zip(self.partition_by, values, strict=True)) if self.partition_by else WHOLE

    def exists(self) -> bool:
        """Whether a committed version has it (it may have no row)."""
        return self.name in self.versions.current().tables

    def read_at(self, state: State, groups: list[tuple] | None = None) -> DataFrame:
        """Rows of these groups (all by default), with the derived partition columns; no other folder is listed."""
        return self.read_named(state, None if groups is None else {self.group(g) for g in groups})

    def read_named(self, state: State, groups: set[str] | None = None) -> DataFrame:
        """``read_at`` by the names of the groups' folders."""
        full = T.StructType([*self.schema.fields, *(T.StructField(c, T.StringType()) for c in self.derived)])
        folders = state.folders(self.name, groups)
        if not folders:
            return self.spark.createDataFrame([], full)
        reader = self.spark.read.schema(full).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]).select(*full.names)

    def _read(self) -> DataFrame:
        return self.read_at(self.versions.current())

    def read_partitions(self, values: list[tuple]) -> DataFrame:
        return self.read_at(self.versions.current(), values).select(*self.columns)

    def overwrite(self, df: DataFrame, reads_self: bool = False) -> VersionedTable:
        """The whole table in a version of its own (a draft never writes where it reads)."""
        draft = self.versions.begin()
        draft.overwrite(self, df)
        draft.commit()
        return self

    def replace_partitions(self, df: DataFrame, expected: list[tuple] | None = None) -> VersionedTable:
        draft = self.versions.begin()
        draft.replace(self, df, expected if expected is not None else self.touched(df))
        draft.commit()
        return self


class Draft:
    """Changes to versioned tables that readers see together, at ``commit``; its own reads see them before."""

    def __init__(self, versions: Versions):
        self.versions = versions
        now = versions.current()
        self.state = State(now.number + 1, json.loads(json.dumps(now.tables)))

    def together(self, *writes: Callable[[], None]) -> None:
        """Writes of different tables as Spark jobs at the same time."""
        with ThreadPoolExecutor(len(writes)) as pool:
            for done in [pool.submit(w) for w in writes]:
                done.result()

    def clear(self, table: VersionedTable) -> None:
        """Leave the table without rows."""
        self.state.tables[table.name] = {}

    def _write(self, table: VersionedTable, df: DataFrame) -> tuple[str, list[str]]:
        run = f"_run={self.state.number}-{uuid.uuid4().hex[:12]}"
        table.writer(df).mode("errorifexists").save(f"{table.path}/{run}")
        return run, partition_folders(self.versions.spark, f"{table.path}/{run}", len(table.partition_by))

    def overwrite(self, table: VersionedTable, df: DataFrame) -> None:
        run, groups = self._write(table, df)
        self.state.tables[table.name] = {run: {"groups": groups, "written": len(groups)}}

    def replace(self, table: VersionedTable, df: DataFrame, groups: list[tuple]) -> None:
        """Make these groups hold exactly ``df``, whose rows are in them; others keep their folders."""
        run, written = self._write(table, df)
        runs = self.state.tables.setdefault(table.name, {})
        gone = {*(table.group(g) for g in groups), *written}
        for old in list(runs):
            runs[old]["groups"] = [g for g in runs[old]["groups"] if g not in gone]
            if not runs[old]["groups"]:
                del runs[old]
        if written:
            runs[run] = {"groups": written, "written": len(written)}

    def read(self, table: VersionedTable) -> DataFrame:
        return table.read_at(self.state)

    def read_groups(self, table: VersionedTable, groups: list[tuple]) -> DataFrame:
        return table.read_at(self.state, groups)

    def read_named(self, table: VersionedTable, groups: set[str]) -> DataFrame:
        return table.read_named(self.state, groups)

    def commit(self) -> int:
        self.versions.put(self.state)
        return self.state.number
