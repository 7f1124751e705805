"""Overwrites that readers never see half done.

* :class:`DuckDBGenerations` loads a new internal table and turns a view to it in the same transaction.
* :class:`FolderGenerations` does the same for folders of Parquet: a pointer file is replaced.
* :func:`swap_file` replaces a database file by a staged one, and :func:`recover` tidies up after a crash.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablebridge.dialects import DIALECTS
from tablebridge.errors import BridgeError, RemoteFailure, classify
from tablebridge.options import Index
from tablebridge.types import column_type


def create_table_sql(table: str, schema: T.StructType, system: str, primary_key: tuple[str, ...] = (), if_not_exists: bool = True, temporary: bool = False) -> str:
    d = DIALECTS[system]
    columns = [f"{d.quote(f.name)} {column_type(f.dataType, system, table, f.name)}{'' if f.nullable else ' NOT NULL'}" for f in schema]
    if primary_key:
        columns.append(f"PRIMARY KEY ({', '.join(map(d.quote, primary_key))})")
    return f"CREATE {'TEMPORARY ' * temporary}TABLE {'IF NOT EXISTS ' * if_not_exists}{d.table(table)} ({', '.join(columns)})"


def create_type_sql(table: str, field: T.StructField) -> str:
    """PostgreSQL's composite type of a struct column, made if it isn't there."""
    d = DIALECTS["postgres"]
    name = f"struct_{table}_{field.name}"
    inside = ", ".join(f"{d.quote(f.name)} {column_type(f.dataType, 'postgres', table, f'{field.name}_{f.name}')}" for f in field.dataType)
    return f"DO $$ BEGIN CREATE TYPE {d.quote(name)} AS ({inside}); EXCEPTION WHEN duplicate_object THEN NULL; END $$"


def create_index_sql(table: str, index: Index, system: str, if_not_exists: bool = True, name: str | None = None) -> str:
    d = DIALECTS[system]
    return f"CREATE {'UNIQUE ' * index.unique}INDEX {'IF NOT EXISTS ' * if_not_exists}{d.quote(name or index.name(table))} ON {d.table(table)} ({', '.join(map(d.quote, index.columns))})"


class DuckDBGenerations:
    """A logical table ``name`` that is a plain table until its first overwrite, then a view of the newest internal one."""

    def __init__(self, open_: Callable[[], object], name: str, schema: T.StructType, primary_key: tuple[str, ...] = (), indexes: tuple[Index, ...] = ()) -> None:
        self.open, self.name, self.schema, self.primary_key, self.indexes = open_, name, schema, primary_key, indexes

    def internal_tables(self, c) -> list[str]:
        """Oldest first."""
        pattern = re.compile(rf"^__data_{re.escape(self.name)}_(\d+)$")
        names = [r[0] for r in c.execute("SELECT table_name FROM duckdb_tables()").fetchall()]
        return sorted((n for n in names if pattern.match(n)), key=lambda n: int(pattern.match(n)[1]))

    def current(self, c) -> str:
        """Where appends, deletes and updates go."""
        found = self.internal_tables(c)
        return found[-1] if found else self.name

    def overwrite(self, load: Callable[[object, str], int], on_commit: Callable[[object], None] | None = None, analyze: bool = True) -> int:
        """``load(connection, table)`` fills the new table. A failure anywhere before the end leaves the old rows."""
        d, c = DIALECTS["duckdb"], self.open()
        try:
            c.execute("BEGIN")
            try:
                old = self.internal_tables(c)
                new = f"__data_{self.name}_{max([time.time_ns() // 1_000_000, *(int(n.rsplit('_', 1)[1]) + 1 for n in old)])}"
                c.execute(create_table_sql(new, self.schema, "duckdb", self.primary_key))
                rows = load(c, new)
                for i in self.indexes:
                    c.execute(create_index_sql(new, i, "duckdb"))
                if self.name in [r[0] for r in c.execute("SELECT table_name FROM duckdb_tables()").fetchall()]:
                    c.execute(f"DROP TABLE {d.quote(self.name)}")
                c.execute(f"CREATE OR REPLACE VIEW {d.quote(self.name)} AS SELECT * FROM {d.quote(new)}")
                for o in old:
                    c.execute(f"DROP TABLE {d.quote(o)}")
                if on_commit is not None:
                    on_commit(c)
                c.execute("COMMIT")
            except Exception as e:
                c.execute("ROLLBACK")
                raise e if isinstance(e, BridgeError) else classify(e) from e
            if analyze:
                c.execute("ANALYZE")
                c.execute("CHECKPOINT")
            return rows
        finally:
            c.close()


class FolderGenerations:
    """A table of Parquet folders under one root: ``current.json`` names the one that readers take."""

    def __init__(self, root: str) -> None:
        self.root = root

    @property
    def pointer(self) -> str:
        return os.path.join(self.root, "current.json")

    def current(self) -> str | None:
        try:
            with open(self.pointer) as f:
                return os.path.join(self.root, json.load(f)["folder"])
        except FileNotFoundError:
            return None

    def read(self, spark: SparkSession) -> DataFrame:
        at = self.current()
        if at is None:
            raise BridgeError(f"{self.root} has no generation yet")
        return spark.read.parquet(at)

    def overwrite(self, df: DataFrame) -> str:
        folder = f"g_{time.time_ns()}_{uuid.uuid4().hex[:8]}"
        path, old = os.path.join(self.root, folder), self.current()
        try:
            df.write.parquet(path)
        except BaseException:
            shutil.rmtree(path, ignore_errors=True)
            raise
        temporary = f"{self.pointer}.{uuid.uuid4().hex}"
        with open(temporary, "w") as f:
            json.dump({"folder": folder}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, self.pointer)
        if old:
            shutil.rmtree(old, ignore_errors=True)
        return path

    def recover(self) -> list[str]:
        """Remove generations that no pointer names: what a crash left."""
        keep = os.path.basename(self.current() or "")
        gone = [n for n in os.listdir(self.root) if n.startswith("g_") and n != keep] if os.path.isdir(self.root) else []
        for n in gone:
            shutil.rmtree(os.path.join(self.root, n), ignore_errors=True)
        return gone


def swap_file(path: str, build: Callable[[str], None]) -> None:
    """Build a database beside ``path`` and put it in its place. A file that changed hands meanwhile is left alone."""
    before = os.stat(path) if os.path.exists(path) else None
    staged = f"{path}.staged.{uuid.uuid4().hex}"
    try:
        build(staged)
        now = os.stat(path) if os.path.exists(path) else None
        if (before and (before.st_dev, before.st_ino)) != (now and (now.st_dev, now.st_ino)):
            raise RemoteFailure(f"{path} was replaced by someone else")
        # One step: readers find the old file or the new one at any moment.
        os.replace(staged, path)
    finally:
        for left in (staged, f"{staged}.wal"):
            if os.path.exists(left):
                os.remove(left)


def recover(path: str) -> str:
    """After a crash in :func:`swap_file`: staged files go. A ``.previous`` file, of a swap in two steps, comes back if its
    successor isn't there."""
    did, previous = "nothing", f"{path}.previous"
    if os.path.exists(previous):
        if os.path.exists(path):
            os.remove(previous)
            did = "kept the new file"
        else:
            os.replace(previous, path)
            did = "restored the previous file"
    folder, base = os.path.split(os.path.abspath(path))
    for n in os.listdir(folder):
        if n.startswith(f"{base}.staged."):
            os.remove(os.path.join(folder, n))
            did = did if did != "nothing" else "removed a staged file"
    return did
