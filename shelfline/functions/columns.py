"""Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline import fixed_values as fixed


def named(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def as_double(column: Column | str) -> Column:
    """A number, or NULL where the value is none."""
    return named(column).try_cast("double")


def as_int(column: Column | str) -> Column:
    """The whole part of any number, also one written 990.0 or 9.9e2, or NULL where the value is none or does not fit."""
    return named(column).try_cast("double").try_cast("int")


def utc_date(iso_text: Column | str) -> Column:
    """The date an ISO-8601 text starts with, whatever the session time zone."""
    return named(iso_text).try_cast("date")


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def steps(value: Column, labels: Iterable[tuple[str, float]], inclusive: bool) -> Column:
    """The first label whose limit the value passes; open-ended, the caller adds the rest."""
    case = None
    for label, limit in labels:
        passed = value >= limit if inclusive else value > limit
        case = F.when(passed, label) if case is None else case.when(passed, label)
    return case


def lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """The value a small fixed mapping holds for a key, else NULL."""
    pairs = [F.lit(text) for item in mapping.items() for text in item]
    return F.try_element_at(F.create_map(*pairs), key)


def run_time(run_ts: dt.datetime | None) -> Column:
    """The time of this run: the given one, or the time the query starts."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def op_code(operation: Column | str) -> Column:
    """I, U or D for insert, update or delete; codes stay as they are."""
    return F.coalesce(lookup(fixed.OP_CODES, F.lower(named(operation))), named(operation))


def op_name(code: Column | str) -> Column:
    """insert, update or delete for a code."""
    return lookup({code_: name for name, code_ in fixed.OP_CODES.items()}, named(code))


def next_status(status: Column | str) -> Column:
    """The status that follows; NULL after the last one."""
    return lookup(fixed.NEXT_STATUS, named(status))


def iso_text(time: Column | str) -> Column:
    """ISO-8601 text with microseconds and offset, as scrapes carry it."""
    return F.date_format(named(time), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def date_folder(time: Column | str) -> Column:
    """``yyyy/MM/dd``, the folder layout of the change log."""
    return F.date_format(named(time), "yyyy/MM/dd")


def file_stamp(iso: Column | str) -> Column:
    """A time text without the colons that file names may not hold."""
    return F.replace(named(iso), F.lit(":"), F.lit("-"))
