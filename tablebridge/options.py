"""The grammar of options: prefixes, key lists, column references, conflict rules, secrets, endpoints."""

from __future__ import annotations

import re
import socket
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from tablebridge.errors import InvalidOption


def strip_prefixes(options: Mapping[str, str], *prefixes: str) -> dict[str, str]:
    """Options without a leading ``prefix_`` or ``prefix.``; a prefixed key wins over a plain one."""
    plain, own = {}, {}
    for key, value in options.items():
        for p in prefixes:
            if key.startswith((f"{p}_", f"{p}.")):
                own[key[len(p) + 1 :]] = value
                break
        else:
            plain[key] = value
    return plain | own


def parse_pairs(text: str) -> dict[str, str]:
    """``a:x;b:y`` as a dict; a part without a colon maps to the empty string."""
    out = {}
    for part in filter(None, (p.strip() for p in text.split(";"))):
        key, _, value = part.partition(":")
        if not key.strip():
            raise InvalidOption(f"a key is missing in {part!r}")
        out[key.strip()] = value.strip()
    return out


_NAME = re.compile(r'^(?:[^\s(),;:"]+|"[^"]+")$')


def parse_columns(text: str) -> tuple[str, ...]:
    """``a`` or ``(b, a)``: a column reference. Columns are sorted, so equal sets are equal references."""
    inner = text.strip()
    if inner.startswith("(") != inner.endswith(")"):
        raise InvalidOption(f"unbalanced parentheses in the column reference {text!r}")
    if inner.startswith("("):
        inner = inner[1:-1]
    names = [n.strip() for n in inner.split(",")]
    if not all(_NAME.match(n) for n in names):
        raise InvalidOption(f"not a column reference: {text!r}")
    names = [n.strip('"') for n in names]
    if len(set(names)) < len(names):
        raise InvalidOption(f"a column is named twice in {text!r}")
    return tuple(sorted(names))


@dataclass(frozen=True)
class Index:
    columns: tuple[str, ...]
    unique: bool = False

    def name(self, table: str) -> str:
        return f"i_{table}_{'_'.join(self.columns)}"


def parse_indexes(text: str) -> list[Index]:
    """``(a,b):unique;c`` as indexes; ``enabled`` is the plain kind."""
    out = []
    for columns, kind in parse_pairs(text).items():
        if kind not in ("", "enabled", "unique"):
            raise InvalidOption(f"unknown kind of index {kind!r}; it is enabled or unique")
        out.append(Index(parse_columns(columns), kind == "unique"))
    return out


@dataclass(frozen=True)
class OnConflict:
    """What an insert does about rows whose key exists. ``columns`` is empty for do-nothing on any key."""

    action: str
    columns: tuple[str, ...] = ()

    def sql(self, quote: Callable[[str], str], all_columns: Iterable[str]) -> str:
        target = f" ({', '.join(map(quote, self.columns))})" if self.columns else ""
        rest = [c for c in all_columns if c not in self.columns]
        if self.action == "do_nothing" or not rest:  # an upsert of keys alone has nothing to set
            return f"ON CONFLICT{target} DO NOTHING"
        return f"ON CONFLICT{target} DO UPDATE SET " + ", ".join(f"{quote(c)} = EXCLUDED.{quote(c)}" for c in rest)


def parse_on_conflict(text: str) -> OnConflict:
    """``do_nothing_all``, ``do_nothing:(a,b)`` or ``upsert:(a,b)``; action and columns are divided by a colon."""
    text = text.strip()
    if text == "do_nothing_all":
        return OnConflict("do_nothing")
    action, colon, columns = text.partition(":")
    if action not in ("do_nothing", "upsert") or not colon or ":" in columns or ";" in columns:
        raise InvalidOption(f"not a conflict rule: {text!r}; expected do_nothing_all, do_nothing:<columns> or upsert:<columns>, divided by one colon")
    return OnConflict(action, parse_columns(columns))


class Secret:
    """A value that doesn't show itself in logs, plans or errors."""

    def __init__(self, value: str | Callable[[], str]) -> None:
        self._value = value

    def reveal(self) -> str:
        return self._value() if callable(self._value) else self._value

    def __repr__(self) -> str:
        return "Secret(***)"

    __str__ = __repr__


SECRET_KEYS = frozenset({"password", "pass", "pwd", "token", "secret", "sslkey", "connection_string"})


def with_secrets(options: Mapping[str, object]) -> dict[str, object]:
    return {k: Secret(v) if k.lower() in SECRET_KEYS and not isinstance(v, Secret) else v for k, v in options.items()}


def as_bool(value: object, name: str = "option") -> bool:
    text = str(value).strip().lower()
    if text in ("true", "1", "yes", "on", "enabled"):
        return True
    if text in ("false", "0", "no", "off", "disabled"):
        return False
    raise InvalidOption(f"{name} must be true or false, not {value!r}")


def check_endpoint(host: str, port: int, timeout: float = 30.0) -> None:
    """Resolve and reach a host before a pool is made, so that a wrong name is told as such."""
    try:
        found = socket.getaddrinfo(host, port, type=socket.SOCK_STREAM)
    except OSError as e:
        raise InvalidOption(f"the host {host!r} can't be resolved: {e}") from None
    last: OSError | None = None
    for family, kind, protocol, _, address in found:
        try:
            with socket.socket(family, kind, protocol) as s:
                s.settimeout(timeout)
                s.connect(address)
                return
        except OSError as e:
            last = e
    raise InvalidOption(f"{host}:{port} can't be reached: {last}")
