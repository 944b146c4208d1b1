"""Filters and predicates.

Each builder returns a ``Column`` predicate so predicates compose with
``all_of`` / ``any_of`` / ``negate`` exactly as SQL's AND / OR / NOT (M7:
NOT binds tighter than AND, AND tighter than OR -- here the nesting is
explicit, so no precedence surprise from Python's ``&``/``|``).

Comparisons, ``IN``, ``IS [NOT] NULL`` and ``LIKE 'x%'`` / ``'%x'`` /
``'%x%'`` reach the Parquet scan as pushed filters.  Other patterns -- ``LIKE``
with ``_``, ``ILIKE`` -- are evaluated per row after the scan, but what they
imply (a fixed beginning, end or part) is pushed (``implied``).  Filter the raw column -- a predicate over
``coalesce(col, ..)`` or ``date_format(col, ..)`` is not pushed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relq.functions.expressions import ColumnOrName, col

_OPS = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def compare(c: ColumnOrName, op: str, value) -> Column:
    """``c <op> value`` for ``= <> != > >= < <=``."""
    return _OPS[op](col(c), _lit(value))


def eq(c: ColumnOrName, value) -> Column:
    return compare(c, "=", value)


def ne(c: ColumnOrName, value) -> Column:
    return compare(c, "<>", value)


def all_of(*preds: Column) -> Column:
    """``p AND q AND ...``."""
    return reduce(lambda a, b: a & b, preds)


def any_of(*preds: Column) -> Column:
    """``(p OR q OR ...)``."""
    return reduce(lambda a, b: a | b, preds)


def negate(pred: Column) -> Column:
    """``NOT p`` (F6): NOT of UNKNOWN stays UNKNOWN, so NULL rows stay out."""
    return ~pred


def in_list(c: ColumnOrName, values: Iterable) -> Column:
    """``c IN (v1, v2, ...)``."""
    return col(c).isin(list(values))


def between(c: ColumnOrName, low, high) -> Column:
    """``c BETWEEN low AND high``, both ends included."""
    return col(c).between(_lit(low), _lit(high))


def is_null(c: ColumnOrName) -> Column:
    return col(c).isNull()


def is_not_null(c: ColumnOrName) -> Column:
    return col(c).isNotNull()


# ASCII letters that lower() also makes of another character (KELVIN SIGN,
# capital I with a dot above): their two cases are not all that ILIKE accepts.
_MORE_CASES = {"k", "i"}
_FOLDED = 2  # letters whose cases are spelled out: at most 2 ** 2 beginnings


def _literals(pattern: str) -> tuple[str, str, list[str]]:
    """Text before the first wildcard, behind the last, and between wildcards."""
    parts = re.split("[%_]", pattern)
    return parts[0], parts[-1], parts[1:-1]


def implied(c: ColumnOrName, pattern: str, case_sensitive: bool = True) -> Column | None:
    """A predicate that every value matching ``pattern`` fulfils and that the
    Parquet scan can evaluate, or None where Spark derives all of it itself.

    ``LIKE``: the fixed beginning and end and the longest fixed part between.
    ``ILIKE``: the beginning, in all cases of its first letters; a letter is
    only used while ``lower()`` maps nothing but its two cases to it.
    """
    value = col(c)
    begin, end, middle = _literals(pattern)
    if not case_sensitive:
        usable = ""
        for ch in begin:
            if not ch.isascii() or ch.lower() in _MORE_CASES or sum(x.isalpha() for x in usable) == _FOLDED:
                break
            usable += ch
        if not usable:
            return None
        spelled = ["".join(x) for x in product(*[sorted({ch.lower(), ch.upper()}) for ch in usable])]
        return any_of(*[value.startswith(x) for x in spelled])
    if "_" not in pattern:
        return None  # Spark turns it into StartsWith, EndsWith, Contains or equality
    parts = [value.startswith(begin)] * bool(begin) + [value.endswith(end)] * bool(end)
    longest = max(middle, key=len, default="")
    parts += [value.contains(longest)] * bool(longest)
    return all_of(*parts) if parts else None


def like(c: ColumnOrName, pattern: str, case_sensitive: bool = True) -> Column:
    """``c LIKE pattern`` (F12-F16); ``case_sensitive=False`` gives ``ILIKE``.

    ``%`` matches any run, ``_`` exactly one character.  Spark's LIKE is
    case-sensitive (the course's SQLite engine folds ASCII case), so the
    case-insensitive form is offered explicitly.  There is no escape
    character: a backslash in ``pattern`` stands for itself.  What the pattern
    implies goes along, so that the scan can leave out row groups and rows.
    """
    escaped = pattern.replace("\\", "\\\\")  # Spark's own default escape, escaped
    exact = col(c).like(escaped) if case_sensitive else col(c).ilike(escaped)
    pushed = implied(c, pattern, case_sensitive)
    return exact if pushed is None else pushed & exact


def eq_null(c: ColumnOrName) -> Column:
    """The ``c = NULL`` pitfall (F17): always UNKNOWN, so it keeps no row."""
    return col(c) == F.lit(None)


def where(df: DataFrame, *preds: Column) -> DataFrame:
    """``WHERE p1 AND p2 ...``: keeps only rows where the predicate is TRUE."""
    return df.filter(all_of(*preds)) if preds else df


def in_subquery(df: DataFrame, keys: str | Sequence[str], sub: DataFrame,
                sub_keys: str | Sequence[str] | None = None) -> DataFrame:
    """``WHERE k IN (SELECT k FROM sub WHERE ...)`` (F8) as a left-semi join.

    Each left row is kept at most once however many matches ``sub`` holds, so
    duplicate keys in the subquery never multiply rows.  ``joins.key_probe``
    collapses repeated subquery keys before they are shuffled or broadcast and
    lets a hot key of ``df`` be split.
    """
    from relq.operators.joins import key_probe  # joins builds on this module

    keys = [keys] if isinstance(keys, str) else list(keys)
    sub_keys = keys if sub_keys is None else ([sub_keys] if isinstance(sub_keys, str) else list(sub_keys))
    return key_probe(df, keys, sub, sub_keys, "left_semi")
