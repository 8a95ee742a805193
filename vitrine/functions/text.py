"""String cleaning expressions.

All functions take and return ``Column`` so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.constants import STOP_TOKENS

# Java regex: (?U) makes \s match Unicode white space (NBSP, thin space, ...)
# the way Python's str.split/strip do; plain trim() only strips U+0020.
_WS_RUN = r"(?U)\s+"
_EDGE_WS = r"(?U)^\s+|\s+$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body(x)``.

    Column expressions are trees: reusing a Python variable copies the
    subtree, and nested reuse grows the generated code exponentially (and
    re-runs regexes).  Binding through a one-element ``transform`` makes the
    value a lambda variable that is computed once per row.
    """
    return F.get(F.transform(F.array(value), body), 0)


def py_strip(c: Column | str) -> Column:
    """Strip leading/trailing Unicode white space."""
    return F.regexp_replace(col_(c), _EDGE_WS, "")


def collapse_ws(c: Column | str) -> Column:
    """Strip, then turn every inner white-space run into one space."""
    return py_strip(F.regexp_replace(col_(c), _WS_RUN, " "))


def clean_text(c: Column | str) -> Column:
    """Lower-case, collapse white space, stop tokens -> NULL.

    After every white-space run became one U+0020, ``trim`` (spaces only) is
    the same as a Unicode strip.
    """
    s = F.trim(F.regexp_replace(F.lower(col_(c)), _WS_RUN, " "))
    return F.when(s.isin(STOP_TOKENS), F.lit(None).cast("string")).otherwise(s)


def soft_clean(c: Column | str) -> Column:
    """Lower-case, ``[-_/|]`` runs and white space -> one space, comma -> dot."""
    s = F.regexp_replace(F.lower(col_(c)), r"[-_/|]+", " ")
    s = F.replace(s, F.lit(","), F.lit("."))
    return collapse_ws(s)


def blank_to_null(c: Column | str) -> Column:
    """empty / blank form value -> NULL, otherwise trimmed text."""
    return F.nullif(py_strip(col_(c)), F.lit(""))


def display_or_dash(c: Column | str) -> Column:
    """NULL shown as '-'."""
    return F.coalesce(col_(c).cast("string"), F.lit("-"))


def try_cast(c: Column | str, dtype: str) -> Column:
    """Cast that yields NULL instead of an ANSI error."""
    return col_(c).try_cast(dtype)
