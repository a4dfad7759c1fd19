"""Cleaning column builders (CLN-2, CLN-3, CLN-4, CLN-6, CLN-7).

Each function takes and returns a ``Column`` so the work stays inside
whole-stage codegen; there is no Python UDF anywhere in the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.functions import _col

# Fixed values that must equal the reference's loader defaults.
UNKNOWN_STATION = "Unknown Station"
UNKNOWN_SERVICE = "UNKNOWN"
DEFAULT_ROUTE_TYPE = 2  # rail

# Python's str.strip() removes any whitespace (tabs, newlines, NBSP ...);
# Spark's trim() only removes spaces, so strip with a regex instead.
_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_EDGE_SPACE = "^" + _WS + "+|" + _WS + "+$"


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(_col(c), _EDGE_SPACE, "")


def empty_to_null(c) -> Column:
    """'' -> NULL, everything else unchanged (no trimming)."""
    return F.nullif(_col(c), F.lit(""))


def clean_text(c, max_length: int | None = None) -> Column:
    """CLN-3: strip, blank -> NULL, truncate to ``max_length`` characters."""
    out = F.nullif(strip_ws(c), F.lit(""))
    if max_length:
        out = F.left(out, F.lit(max_length))
    return out


def clean_digits(c) -> Column:
    """CLN-4: a strip-ed all-digit string as an int; anything else NULL.

    Sign, decimal point, blank and non-numeric text all give NULL. Values
    beyond the int range also give NULL (``try_cast``) instead of failing.
    """
    s = strip_ws(c)
    return F.when(s.rlike(r"^[0-9]+$"), s.try_cast("int"))


def cast_strict(c, to: str) -> Column:
    """CLN-2: '' -> NULL, then ANSI cast (bad text raises at run time)."""
    return empty_to_null(c).cast(to)


def cast_lenient(c, to: str) -> Column:
    """CLN-2 quarantine mode: '' -> NULL, bad text -> NULL."""
    return empty_to_null(c).try_cast(to)


def default_fill(c, default) -> Column:
    """CLN-6: NULL -> ``default``."""
    return F.coalesce(_col(c), F.lit(default))


def default_route_type(c, falsy_zero: bool = True) -> Column:
    """CLN-7: NULL (and, like the reference, 0 = tram) -> 2 = rail.

    ``falsy_zero=False`` keeps a genuine 0 instead of overwriting it.
    """
    c = _col(c)
    if falsy_zero:
        c = F.nullif(c, F.lit(0))
    return F.coalesce(c, F.lit(DEFAULT_ROUTE_TYPE))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def like_ascii_ci(c, pattern: str) -> Column:
    """SQLite ``LIKE``: case-insensitive for ASCII letters only.

    ``'LIÈGE' LIKE '%liège%'`` is false (È and è differ), unlike Spark's
    ``ilike``, which folds every Unicode letter. ``%`` and ``_`` are
    wildcards.
    """
    folded = F.translate(_col(c), _UPPER, _LOWER)
    return folded.like(pattern.translate(str.maketrans(_UPPER, _LOWER)))
