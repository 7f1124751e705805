"""Predicates in other forms: from Spark's pushed filters, from SQL text, to filter documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from tablebridge import sqlgen as q
from tablebridge.dialects import Dialect
from tablebridge.errors import UnsupportedExpression


def from_spark_filter(f: object) -> q.Expr | None:
    """A filter that Spark offers to a Python data source, or None where it has no exact form."""
    from pyspark.sql import datasource as ds

    def column(path: tuple[str, ...]) -> q.Column:
        if len(path) != 1:
            raise UnsupportedExpression("a nested column")
        return q.Column(path[0])

    like = lambda s: re.sub(r"([%_\\])", r"\\\1", s)
    try:
        if isinstance(f, ds.Not):
            inner = from_spark_filter(f.child)
            return None if inner is None else q.Not(inner)
        at = column(f.attribute)
        for kind, op in ((ds.EqualTo, "="), (ds.EqualNullSafe, "<=>"), (ds.GreaterThan, ">"), (ds.GreaterThanOrEqual, ">="), (ds.LessThan, "<"), (ds.LessThanOrEqual, "<=")):
            if isinstance(f, kind):
                return q.Binary(op, at, q.Literal(f.value))
        if isinstance(f, ds.In):
            return q.InList(at, tuple(q.Literal(v) for v in f.value))
        if isinstance(f, ds.IsNull):
            return q.IsNull(at)
        if isinstance(f, ds.IsNotNull):
            return q.IsNull(at, negated=True)
        if isinstance(f, ds.StringStartsWith):
            return q.Like(at, like(f.value) + "%", escape="\\")
        if isinstance(f, ds.StringEndsWith):
            return q.Like(at, "%" + like(f.value), escape="\\")
        if isinstance(f, ds.StringContains):
            return q.Like(at, "%" + like(f.value) + "%", escape="\\")
    except UnsupportedExpression:
        return None
    return None


# ---- LIKE as a regular expression


def like_to_regex(pattern: str, escape: str | None = None) -> str:
    """An anchored regular expression; wildcards match line ends too."""
    out, i = ["^"], 0
    while i < len(pattern):
        c = pattern[i]
        if escape and c == escape:
            i += 1
            if i >= len(pattern):
                raise UnsupportedExpression("a pattern ends in its escape character")
            out.append(re.escape(pattern[i]))
        elif c == "%":
            out.append(r"[\s\S]*")
        elif c == "_":
            out.append(r"[\s\S]")
        else:
            out.append(re.escape(c))
        i += 1
    return "".join(out) + "$"


# ---- filter documents

_FLIP = {"=": "=", "<>": "<>", "<": ">", "<=": ">=", ">": "<", ">=": "<="}
_WORD = {"=": "$eq", "<>": "$ne", "<": "$lt", "<=": "$lte", ">": "$gt", ">=": "$gte"}
#: Casts that keep every value apart and in order, so that a comparison may look through them.
_LOSSLESS = frozenset({"bigint", "double", "string", "text", "varchar"})


def _field(e: q.Expr) -> str | None:
    if isinstance(e, q.Cast) and e.type.lower() in _LOSSLESS:
        return _field(e.child)
    return e.name if isinstance(e, q.Column) else None


def _value(e: q.Expr) -> object:
    if isinstance(e, q.Literal):
        return e.value
    if isinstance(e, q.Negative):
        return -_value(e.child)
    if isinstance(e, q.Cast):
        value, kind = _value(e.child), e.type.lower()
        for kinds, make in ((("int", "integer", "bigint"), int), (("double", "float", "real"), float), (("string", "text", "varchar"), str)):
            if kind in kinds:
                return None if value is None else make(value)
    raise UnsupportedExpression("not a constant")


def to_document(e: q.Expr) -> dict:
    """A predicate as a filter document. SQL's logic holds: negations match neither null nor missing fields."""
    return _document(e, False)


def _known(field: str, condition: dict) -> dict:
    return {"$and": [{field: {"$ne": None}}, {field: condition}]}


def _document(e: q.Expr, negated: bool) -> dict:
    if isinstance(e, q.Not):
        return _document(e.child, not negated)
    if isinstance(e, q.Binary) and e.op in ("AND", "OR"):
        # De Morgan keeps negations at the leaves, where nulls are dealt with.
        word = "$and" if (e.op == "AND") != negated else "$or"
        return {word: [_document(e.left, negated), _document(e.right, negated)]}
    if isinstance(e, q.Binary) and e.op in _WORD:
        op, field, other = e.op, _field(e.left), e.right
        if field is None:
            op, field, other = _FLIP[e.op], _field(e.right), e.left
        if field is None:
            raise UnsupportedExpression("a comparison without a column")
        value = _value(other)
        if value is None:
            return {"$nor": [{}]}  # a comparison with null is never true, nor is its negation
        if negated:
            op = {"=": "<>", "<>": "=", "<": ">=", ">=": "<", ">": "<=", "<=": ">"}[op]
        return _known(field, {"$ne": value}) if op == "<>" else {field: {_WORD[op]: value}}
    field = _field(getattr(e, "child", None)) if getattr(e, "child", None) is not None else None
    if isinstance(e, q.Column):
        return {e.name: {"$eq": not negated}}
    if field is None:
        raise UnsupportedExpression(type(e).__name__)
    if isinstance(e, q.IsNull):
        return {field: {"$ne" if e.negated != negated else "$eq": None}}
    if isinstance(e, q.IsTruth):
        return {field: {"$ne" if e.negated != negated else "$eq": e.value}}
    negated = getattr(e, "negated", False) != negated
    if isinstance(e, q.Between):
        low, high = _value(e.low), _value(e.high)
        if low is None or high is None:
            raise UnsupportedExpression("a range with a null end")
        return {"$or": [{field: {"$lt": low}}, {field: {"$gt": high}}]} if negated else {field: {"$gte": low, "$lte": high}}
    if isinstance(e, q.InList):
        values = [_value(v) for v in e.values]
        known = [v for v in values if v is not None]
        if negated:
            return {"$nor": [{}]} if len(known) < len(values) else _known(field, {"$nin": known})
        return {field: {"$in": known}}
    if isinstance(e, q.Like):
        condition = {"$regex": like_to_regex(e.pattern, e.escape)} | ({"$options": "i"} if e.ignore_case else {})
        return _known(field, {"$not": condition}) if negated else {field: condition}
    raise UnsupportedExpression(type(e).__name__)


def matches(document: Mapping, filter_: Mapping) -> bool:
    """Whether a document fits a filter document: what a document store does with it."""
    for key, condition in filter_.items():
        if key == "$and":
            ok = all(matches(document, c) for c in condition)
        elif key == "$or":
            ok = any(matches(document, c) for c in condition)
        elif key == "$nor":
            ok = not any(matches(document, c) for c in condition)
        else:
            ok = _fits(_dig(document, key), condition)
        if not ok:
            return False
    return True


def _dig(document: object, path: str) -> object:
    if isinstance(document, Mapping) and path in document:
        return document[path]
    for part in path.split("."):
        document = document.get(part) if isinstance(document, Mapping) else None
    return document


def _same_kind(a: object, b: object) -> bool:
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    return (number(a) and number(b)) or type(a) is type(b)


_TESTS: dict[str, Callable[[object, object], bool]] = {
    "$eq": lambda a, b: a is None if b is None else _same_kind(a, b) and a == b,
    "$ne": lambda a, b: not (a is None if b is None else _same_kind(a, b) and a == b),
    "$lt": lambda a, b: _same_kind(a, b) and a < b,
    "$lte": lambda a, b: _same_kind(a, b) and a <= b,
    "$gt": lambda a, b: _same_kind(a, b) and a > b,
    "$gte": lambda a, b: _same_kind(a, b) and a >= b,
    "$in": lambda a, b: any(_TESTS["$eq"](a, x) for x in b),
    "$nin": lambda a, b: not any(_TESTS["$eq"](a, x) for x in b),
}


def _fits(value: object, condition: object) -> bool:
    if not isinstance(condition, Mapping):
        return _TESTS["$eq"](value, condition)
    for word, wanted in condition.items():
        if word == "$options":
            continue
        if word == "$regex":
            flags = re.IGNORECASE if "i" in condition.get("$options", "") else 0
            ok = isinstance(value, str) and re.search(wanted, value, flags) is not None
        elif word == "$not":
            ok = not _fits(value, wanted)
        elif word in _TESTS:
            ok = _TESTS[word](value, wanted)
        else:
            raise UnsupportedExpression(word)
        if not ok:
            return False
    return True


# ---- filters of DELETE and UPDATE


def dml_where(filters: list[q.Expr | str], d: Dialect) -> str:
    """Filters joined with AND; none is the empty string."""
    return " AND ".join(f if isinstance(f, str) else q.write(f, d) for f in filters)


# ---- in Spark


def to_column(e: q.Expr):
    """A predicate as a Spark column: what stays with Spark when a source can't take it."""
    from functools import reduce
    from operator import or_

    from pyspark.sql import functions as F

    if isinstance(e, q.Column):
        return F.col(f"`{e.name}`")
    if isinstance(e, q.Literal):
        return F.lit(e.value)
    if isinstance(e, q.Not):
        return ~to_column(e.child)
    if isinstance(e, q.Negative):
        return -to_column(e.child)
    if isinstance(e, q.Cast):
        return to_column(e.child).cast(e.type)
    if isinstance(e, q.IsNull):
        return to_column(e.child).isNotNull() if e.negated else to_column(e.child).isNull()
    if isinstance(e, q.IsTruth):
        same = to_column(e.child).eqNullSafe(F.lit(e.value))
        return ~same if e.negated else same
    if isinstance(e, q.Between):
        inside = to_column(e.child).between(to_column(e.low), to_column(e.high))
        return ~inside if e.negated else inside
    if isinstance(e, q.InList):
        child = to_column(e.child)
        found = reduce(or_, (child == to_column(v) for v in e.values)) if e.values else child != child
        return ~found if e.negated else found
    if isinstance(e, q.Like):
        child, pattern = to_column(e.child), F.lit(e.pattern)
        escape = F.lit(e.escape) if e.escape else None
        found = (F.ilike if e.ignore_case else F.like)(child, pattern, escape) if escape is not None else (child.ilike(e.pattern) if e.ignore_case else child.like(e.pattern))
        return ~found if e.negated else found
    if isinstance(e, q.Binary):
        a, b = to_column(e.left), to_column(e.right)
        made = {"=": lambda: a == b, "<=>": lambda: a.eqNullSafe(b), "<>": lambda: a != b, "<": lambda: a < b, "<=": lambda: a <= b, ">": lambda: a > b, ">=": lambda: a >= b, "AND": lambda: a & b, "OR": lambda: a | b, "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a / b, "%": lambda: a % b}
        if e.op in made:
            return made[e.op]()
    raise UnsupportedExpression(type(e).__name__)
