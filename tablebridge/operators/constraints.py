"""Uniqueness of rows, over whole DataFrames. Nulls are equal to each other here, as in GROUP BY."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.errors import ConstraintViolation, SchemaMismatch
from tablebridge.options import Index


def violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that more than one row has, with n_rows. One shuffle of counted keys."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def validate(df: DataFrame, keys: Iterable[Sequence[str]]) -> None:
    """Raise with up to five examples if a key isn't unique."""
    for key in keys:
        found = violations(df, key).limit(5).collect()
        if found:
            shown = "; ".join(", ".join(f"{k}={r[k]!r}" for k in key) + f" in {r['n_rows']} rows" for r in found)
            raise ConstraintViolation(f"({', '.join(key)}) is not unique: {shown}")


def drift(declared: T.StructType, stored: T.StructType, primary_key: Sequence[str] = (), stored_key: Sequence[str] = (), indexes: Iterable[Index] = (), stored_indexes: Iterable[Index] = (), strict: bool = True) -> list[str]:
    """How a stored table differs from its declaration: columns, types, key, indexes. With ``strict`` a difference raises."""
    out = []
    have = {f.name: f.dataType for f in stored}
    out += [f"column {f.name} is missing" for f in declared if f.name not in have]
    out += [f"column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in declared if f.name in have and have[f.name] != f.dataType]
    out += [f"column {n} is not declared" for n in have if n not in declared.names]
    if tuple(sorted(primary_key)) != tuple(sorted(stored_key)):
        out.append(f"the primary key is ({', '.join(stored_key)}), not ({', '.join(primary_key)})")
    a, b = set(indexes), set(stored_indexes)
    out += [f"index on ({', '.join(i.columns)}) is missing" for i in sorted(a - b, key=lambda i: i.columns)]
    out += [f"index on ({', '.join(i.columns)}) is not declared" for i in sorted(b - a, key=lambda i: i.columns)]
    if out and strict:
        raise SchemaMismatch("; ".join(out))
    return out
