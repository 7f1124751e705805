"""Databases with the driver's tables, made once for each input folder and process by the package's own writers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

from tablebridge.catalog import Database, open_database
from tablebridge.errors import BridgeError
from tablebridge.options import Index

_MADE: dict[str, str] = {}
#: Which tables live in which database file.
LAYOUT = {"sales": {"customer": ("c_custkey",), "orders": ("o_orderkey",)}, "reference": {"nation": ("n_nationkey",), "region": ("r_regionkey",), "supplier": ("s_suppkey",), "part": ("p_partkey",)}}


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared() -> str | None:
    """Where all executors see files: a mounted spark.checkpoint.dir; on one machine its own temporary folder will do."""
    spark = SparkSession.getActiveSession()
    path = spark.conf.get("spark.checkpoint.dir", None) if spark else None
    if path and (path.startswith("/") or path.startswith("file:")):
        path = "/" + path.removeprefix("file:").lstrip("/")
        os.makedirs(path, exist_ok=True)
        return path
    if spark and spark.sparkContext.master.split("[")[0] != "local":
        raise BridgeError("database files need a mounted folder that all executors share: set spark.checkpoint.dir to one")
    return None


def folder(sf_dir: str) -> str:
    """A scratch folder of this process for an input folder; it goes when the process ends."""
    if sf_dir not in _MADE:
        _MADE[sf_dir] = tempfile.mkdtemp(prefix="tablebridge-", dir=_shared())
        atexit.register(shutil.rmtree, _MADE[sf_dir], True)
    return _MADE[sf_dir]


def database(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...] | None = None) -> Database:
    """The SQLite database ``sales`` or ``reference`` with all its tables, or at least those named."""
    path = os.path.join(folder(sf_dir), f"{name}.sqlite")
    db = open_database(spark, "sqlite", path=path, read_write=True)
    for table in LAYOUT[name] if tables is None else tables:
        if not os.path.exists(f"{path}.{table}.ready"):
            df = parquet(spark, sf_dir, table)
            db.create_external_table(table, df.schema, primary_key=LAYOUT[name][table])
            # The key is the table's own constraint: the database checks it as rows arrive.
            db.declared[table] = ((), ())
            db.insert(table, df, mode="overwrite")
            db.analyze(table)
            open(f"{path}.{table}.ready", "w").close()
    return db


def scratch(spark: SparkSession, sf_dir: str, name: str, system: str, df: DataFrame, key: tuple[str, ...] = (), indexes: str = "") -> Database:
    """A new database file that holds ``df`` as table ``t``."""
    extension = {"sqlite": "sqlite", "duckdb": "duckdb"}[system]
    path = os.path.join(folder(sf_dir), f"{name}.{extension}")
    for left in (path, f"{path}-wal", f"{path}-shm", f"{path}.wal"):
        if os.path.exists(left):
            os.remove(left)
    db = open_database(spark, system, path=path, read_write=True)
    db.create_external_table("t", df.schema, primary_key=key, indexes=indexes)
    db.insert("t", df)
    return db


__all__ = ["Index", "database", "folder", "parquet", "scratch"]
