"""Text expressions: keys, labels, id lists, membership and pattern flags."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of conditions in which an unknown (null) condition counts as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def contains_ci(text: Column, words: Sequence[str]) -> Column:
    lowered = F.lower(text)
    return any_of(lowered.contains(w.lower()) for w in words)


def matches_any(columns: Sequence[Column], patterns: Sequence[str]) -> Column:
    """True when a trimmed column equals, ignoring case, one of the anchored alternatives."""
    regex = "(?i)^(" + "|".join(patterns) + ")$"
    return any_of(F.trim(c).rlike(regex) for c in columns)


def event_matches(specs: Sequence[dict[str, str]]) -> Column:
    """OR over specs; each spec is an AND of ``column = value`` tests."""
    def all_equal(spec: dict[str, str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(name) == F.lit(value) for name, value in spec.items()])

    return any_of(all_equal(spec) for spec in specs)


def member_flag(value: Column, members: Sequence[str], yes: str, no: str) -> Column:
    return F.when(F.coalesce(value, F.lit("")).isin(list(members)), F.lit(yes)).otherwise(F.lit(no))


def code_part(code: Column, sep: str, n: int) -> Column:
    """n-th part (from 1) of a separated code; a missing part is an empty string."""
    return F.split_part(code, F.lit(sep), F.lit(n))


def code_number(code: Column, sep: str = "-", n: int = 2) -> Column:
    return F.nullif(code_part(code, sep, n), F.lit("")).try_cast("bigint")


def norm_key(key: Column) -> Column:
    """Key text up to its first hyphen or en dash."""
    return code_part(code_part(key, "-", 1), "–", 1)


def label(a: Column, b: Column, sep: str = "_") -> Column:
    """``a<sep>b``; null when either side is null."""
    return F.concat(a, F.lit(sep), b)


def norm(text: Column) -> Column:
    return F.lower(F.trim(text))


def id_list(text: Column) -> Column:
    """Array of longs from ``{1, 2}``; parts that are not numbers become null."""
    parts = F.split(F.regexp_replace(text, "[{}]", ""), ",")
    return F.transform(parts, lambda part: F.trim(part).try_cast("bigint"))
