"""Column helpers: regular expressions with Unicode classes, nullable extraction, trimming.

Patterns are written once, without flags; `rx` adds Java's flags so that they mean what they mean in
Python: Unicode character classes and case folding, and only \\n as a line end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Unicode's white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once, however often f uses it; plain nesting would copy x's expression."""
    return F.get(F.transform(F.array(x), lambda y: f(y)), F.lit(0))


def rx(pattern: str, ignore_case: bool = False, dot_all: bool = False) -> str:
    return f"(?dU{'i' * ignore_case}{'s' * dot_all}){pattern}"


def matches(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Whether the pattern is found; false for null."""
    return F.coalesce(c.rlike(rx(pattern, ignore_case)), F.lit(False))


def has(c: Column, literal: str) -> Column:
    """Whether the text contains the literal; false for null."""
    return F.coalesce(c.contains(literal), F.lit(False))


def starts(c: Column, prefix: str) -> Column:
    return F.coalesce(c.startswith(prefix), F.lit(False))


def first(c: Column, pattern: str, group: int = 1, ignore_case: bool = False, dot_all: bool = False) -> Column:
    """The first match's group, null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, rx(pattern, ignore_case, dot_all), group), F.lit(""))


def every(c: Column, pattern: str, group: int = 1, ignore_case: bool = False, dot_all: bool = False) -> Column:
    """All matches' groups, in order."""
    return F.regexp_extract_all(c, F.lit(rx(pattern, ignore_case, dot_all)), F.lit(group))


def replace(c: Column, pattern: str, by: str, ignore_case: bool = False, dot_all: bool = False) -> Column:
    return F.regexp_replace(c, rx(pattern, ignore_case, dot_all), by)


def strip(c: Column) -> Column:
    """Without white space at both ends; trim() by itself knows only spaces."""
    return F.btrim(c, F.lit(WHITE))


def first_of(*options: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in options])


def cases(*pairs: tuple[Column, str], otherwise: str | None) -> Column:
    """The label of the first condition that holds."""
    return F.coalesce(*[F.when(cond, F.lit(label)) for cond, label in pairs], F.lit(otherwise))


def votes(*conditions: Column) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("int") for c in conditions])


def count_literal(c: Column, literal: str) -> Column:
    """How often the literal occurs, without overlaps."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(literal), F.lit("")))) / len(literal)).cast("long")


def find(c: Column, literal: str) -> Column:
    """0-based place of the literal, -1 if it doesn't occur."""
    return F.instr(c, literal) - 1


def locate(c: Column, literal: str) -> Column:
    """LOCATE as MySQL has it: 1-based, 0 if the literal doesn't occur."""
    return F.instr(c, literal)


def mysql_substring(c: Column, start: Column, length: int) -> Column:
    """SUBSTRING as MySQL has it: from place 0 it is empty."""
    return F.when(start == 0, F.lit("")).otherwise(F.substring(c, start, F.lit(length)))


def leading_int(c: Column) -> Column:
    """The number a text begins with, as parseInt reads it."""
    return F.regexp_extract(c, r"^\s*(-?\d+)", 1).try_cast("long")


def shorten_label(c: Column) -> Column:
    """Labels over 40 characters: first and last path segment around `...`, or the first 37 characters."""
    parts = F.split(c, "/")
    both = F.concat(F.get(parts, F.lit(0)), F.lit("/.../"), F.element_at(parts, -1))
    return F.when(F.length(c) <= 40, c).when(F.size(parts) > 2, both).otherwise(F.concat(F.substring(c, 1, 37), F.lit("...")))



def decode_escapes(c: Column) -> Column:
    """MySQL's backslash escapes undone: \\n, \\r, \\t, \\0, \\Z and \\b, and any other character for itself."""
    t = F.replace(c, F.lit("\\\\"), F.lit("\x00"))  # a doubled one stands aside
    for letter, value in (("n", "\n"), ("r", "\r"), ("t", "\t"), ("b", "\b"), ("Z", "\x1a"), ("0", "")):
        t = F.replace(t, F.lit("\\" + letter), F.lit(value))
    return F.replace(F.replace(t, F.lit("\\"), F.lit("")), F.lit("\x00"), F.lit("\\"))


def stamped(name: str, at: Column) -> Column:
    """A file's name with the time in it: name_YYYYMMDD_HHMM."""
    return F.concat(F.lit(f"{name}_"), F.date_format(at, "yyyyMMdd_HHmm"))


def top_of_map(c: Column, k: int) -> Column:
    """The k entries of a map of counts with the greatest counts, ties by key: an array of (key, value)."""
    order = lambda x, y: F.when(x["value"] != y["value"], F.when(x["value"] > y["value"], -1).otherwise(1)).otherwise(F.when(x["key"] < y["key"], -1).otherwise(1))
    return F.slice(F.array_sort(F.map_entries(c), order), 1, k)
