"""Column expressions behind the derived vehicle columns.

All of these are plain Catalyst expressions: they stay inside whole-stage
codegen and need no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inspecta.schema import FEED_DATE_FORMAT, NEVER_MOT, PASSED

AsOf = "str | _dt.date | Column | None"

_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def as_of_col(as_of=None) -> Column:
    """The reference date of a run.  ``None`` means today (CURRENT_DATE)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_test(tests="motTests") -> Column:
    """Last array position (not the latest date); NULL for NULL or []."""
    return F.try_element_at(_col(tests), F.lit(-1))


def last_test_date(tests="motTests") -> Column:
    return last_test(tests).getField("completedDate")


def last_test_result(tests="motTests") -> Column:
    """Result of the last test, 'NEVER MOT' when there is none or it is NULL."""
    return F.coalesce(last_test(tests).getField("testResult"), F.lit(NEVER_MOT))


def to_mileage(value: Column | str, on_bad: str = "error", source_type: T.DataType | None = None) -> Column:
    """Odometer reading -> bigint, like CAST(x AS INT64).

    Text must be an integer literal; anything else raises
    (``on_bad='error'``) or gives NULL (``on_bad='null'``).  Numbers round
    half away from zero.  Written with an explicit pattern so the result
    does not depend on the session's ANSI setting.
    """
    v = _col(value)
    if source_type is not None and isinstance(source_type, T.NumericType):
        return F.round(v).cast("bigint")
    text = v.cast("string")
    ok = text.rlike(_INT_TEXT)
    as_long = F.when(ok, F.trim(text).try_cast("bigint"))
    if on_bad == "null":
        return as_long
    if on_bad != "error":
        raise ValueError("on_bad must be 'error' or 'null'")
    return (F.when(text.isNull(), F.lit(None).cast("bigint"))
            .when(as_long.isNotNull(), as_long)
            .otherwise(F.raise_error(F.concat(F.lit("Bad int64 value: "), text)).cast("bigint")))


def vehicle_age(first_used: Column | str = "firstUsedDate", as_of=None) -> Column:
    """Whole calendar years between first use and ``as_of``.

    Counts year boundaries (DATE_DIFF(..., YEAR)): 31 Dec -> 1 Jan is 1.
    """
    return (F.year(as_of_col(as_of)) - F.year(F.to_date(_col(first_used)))).cast("bigint")


def count_results(tests: Column | str = "motTests", result: str = PASSED) -> Column:
    """Number of tests with the given result; 0 for NULL or empty arrays."""
    n = F.size(F.filter(_col(tests), lambda t: t.getField("testResult") == F.lit(result)))
    return F.coalesce(n, F.lit(0)).cast("bigint")


def feed_date_from_path(path: Column | str) -> Column:
    """Folder date of a feed file minus one day.

    The folder name must end in dd-MM-yyyy; otherwise (or for an invalid
    calendar date) the result is NULL.
    """
    folder_date = F.regexp_extract(_col(path), r"(\d{2}-\d{2}-\d{4})/[^/]*$", 1)
    parsed = F.try_to_timestamp(F.nullif(folder_date, F.lit("")), F.lit(FEED_DATE_FORMAT))
    return F.date_sub(F.to_date(parsed), 1)


def feed_date_string(feed_date: Column | str) -> Column:
    """The ``date`` string the processor adds: dd-MM-yyyy or ''."""
    return F.coalesce(F.date_format(_col(feed_date), FEED_DATE_FORMAT), F.lit(""))


def pass_probability(probs: Column | str = "predicted_last_test_result_probs",
                     label: str = PASSED) -> Column:
    """prob of the entry whose label is PASSED (NULL if absent)."""
    hit = F.filter(_col(probs), lambda p: p.getField("label") == F.lit(label))
    return F.get(hit, 0).getField("prob")
