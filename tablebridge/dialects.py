"""How each system writes names, literals, types, limits, orders, intervals and windows."""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
from dataclasses import dataclass, field

from tablebridge.errors import UnsupportedExpression


@dataclass(frozen=True)
class Dialect:
    name: str
    quote_char: str = '"'
    null_order: bool = True
    ilike: bool = True
    #: Aggregates that lose NULLS FIRST / LAST in a window, and those that lose their frame too.
    window_no_null_order: frozenset = field(default_factory=frozenset)
    window_no_frame: frozenset = field(default_factory=frozenset)

    def quote(self, name: str) -> str:
        q = self.quote_char
        return f"{q}{name.replace(q, q + q)}{q}"

    def table(self, reference: str | tuple[str, ...]) -> str:
        return ".".join(map(self.quote, parse_reference(reference) if isinstance(reference, str) else reference))

    def literal(self, value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return ("1" if value else "0") if self.name == "sqlite" else ("TRUE" if value else "FALSE")
        if isinstance(value, (int, decimal.Decimal)):
            return str(value)
        if isinstance(value, float):
            if math.isfinite(value):
                return repr(value)
            text = "NaN" if math.isnan(value) else ("Infinity" if value > 0 else "-Infinity")
            if self.name in ("postgres", "duckdb"):
                return f"CAST('{text}' AS DOUBLE PRECISION)"
            raise UnsupportedExpression(f"{text} has no literal in {self.name}")
        if isinstance(value, (bytes, bytearray)):
            return f"'\\x{value.hex()}'::bytea" if self.name == "postgres" else f"'{''.join(f'\\x{b:02X}' for b in value)}'::BLOB" if self.name == "duckdb" else f"X'{value.hex()}'"
        if isinstance(value, (dt.datetime, dt.date, dt.time)):
            text = self._escape(value.isoformat(" ") if isinstance(value, dt.datetime) else value.isoformat())
            if self.name == "sqlite":
                return text
            kind = ("TIMESTAMPTZ" if value.tzinfo and self.name in ("postgres", "duckdb") else "TIMESTAMP") if isinstance(value, dt.datetime) else "DATE" if isinstance(value, dt.date) else "TIME"
            return f"{kind} {text}"
        if isinstance(value, dt.timedelta):
            return self.interval(value)
        if isinstance(value, (list, dict, tuple)):
            return self._escape(json.dumps(value, sort_keys=True, separators=(",", ":")))
        return self._escape(str(value))

    def _escape(self, text: str) -> str:
        text = text.replace("'", "''")
        return "'" + (text.replace("\\", "\\\\") if self.name == "mysql" else text) + "'"

    def interval(self, value: dt.timedelta) -> str:
        micros = value.days * 86_400_000_000 + value.seconds * 1_000_000 + value.microseconds
        return f"INTERVAL {micros} MICROSECOND" if self.name == "mysql" else f"INTERVAL '{micros} microseconds'"

    def order(self, column: str, ascending: bool, nulls_first: bool) -> str:
        way = "ASC" if ascending else "DESC"
        if self.null_order:
            return f"{column} {way} NULLS {'FIRST' if nulls_first else 'LAST'}"
        # Without the clause, a first key on nullness puts them in place.
        return f"({column} IS NULL) {'DESC' if nulls_first else 'ASC'}, {column} {way}"

    def limit(self, n: int) -> str:
        return f"LIMIT {int(n)}"

    def add_interval(self, operand: str, months: int = 0, days: int = 0, micros: int = 0) -> str:
        """operand plus an interval. SQLite has none: its date functions take modifiers, and only a part of a day needs datetime()."""
        if self.name == "sqlite":
            steps = []
            years, rest = int(months / 12), months - 12 * int(months / 12)
            for n, unit in ((years, "years"), (rest, "months"), (days, "days")):
                if n:
                    steps.append(f"'{n:+d} {unit}'")
            if micros:
                whole, part = divmod(abs(micros), 1_000_000)
                sign = "-" if micros < 0 else "+"
                steps.append(f"'{sign}{whole}{f'.{part:06d}' if part else ''} seconds'")
            if micros % 1_000_000:
                return f"strftime('%Y-%m-%d %H:%M:%f', {', '.join([operand, *steps])})"
            return f"CAST({'datetime' if micros else 'date'}({', '.join([operand, *steps])}) AS TEXT)"
        if self.name == "mysql":
            out = operand
            for n, unit in ((months, "MONTH"), (days, "DAY"), (micros, "MICROSECOND")):
                if n:
                    out = f"({out} + INTERVAL {n} {unit})"
            return out
        text = " ".join(f"{n} {unit}" for n, unit in ((months, "months"), (days, "days"), (micros, "microseconds")) if n)
        return f"({operand} + INTERVAL '{text or '0 days'}')"

    def window(self, function: str, argument: str, partition: list[str], order: list[tuple[str, bool, bool]], frame: str | None) -> str:
        """An OVER expression, without the parts that the system rejects."""
        name = function.upper()
        plain = name in self.window_no_null_order
        keys = [f"{c} {'ASC' if asc else 'DESC'}" if plain else self.order(c, asc, nulls) for c, asc, nulls in order]
        parts = [f"PARTITION BY {', '.join(partition)}" if partition else "", f"ORDER BY {', '.join(keys)}" if keys else "", frame if frame and name not in self.window_no_frame else ""]
        return f"{name}({argument}) OVER ({' '.join(p for p in parts if p)})"


_RANKS = frozenset({"RANK", "DENSE_RANK", "ROW_NUMBER"})
DIALECTS = {
    "generic": Dialect("generic"),
    "sqlite": Dialect("sqlite", ilike=False),
    "duckdb": Dialect("duckdb"),
    "postgres": Dialect("postgres"),
    "mysql": Dialect("mysql", "`", null_order=False, ilike=False, window_no_null_order=_RANKS | {"SUM", "MAX", "AVG", "MIN", "COUNT"}, window_no_frame=_RANKS),
    "clickhouse": Dialect("clickhouse", "`"),
    "derby": Dialect("derby", ilike=False),
}


def parse_reference(text: str) -> tuple[str, ...]:
    """One to three names divided by dots; quoted names may hold dots."""
    parts, at, n = [], 0, len(text)
    while at <= n:
        if at < n and text[at] in '"`':
            q, out, at = text[at], "", at + 1
            while True:
                end = text.find(q, at)
                if end < 0:
                    raise UnsupportedExpression(f"a quote isn't closed in {text!r}")
                out += text[at:end]
                at = end + 1
                if at < n and text[at] == q:
                    out, at = out + q, at + 1
                    continue
                break
        else:
            end = text.find(".", at)
            end = n if end < 0 else end
            out, at = text[at:end].strip(), end
        if not out:
            raise UnsupportedExpression(f"not a table reference: {text!r}")
        parts.append(out)
        if at >= n:
            break
        if text[at] != ".":
            raise UnsupportedExpression(f"not a table reference: {text!r}")
        at += 1
    if not 1 <= len(parts) <= 3:
        raise UnsupportedExpression(f"a table reference has one to three parts: {text!r}")
    return tuple(parts)
