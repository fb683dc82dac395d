"""Scalar functions on numbers, text, dates/times, arrays and maps
(SURVEY M1-M3, C1-C10, D1-D9, Y1-Y6, K1-K6). All return native Columns.

Under ANSI mode (the Spark 4 default) mixed text/number comparisons, bad
casts and out-of-range array indexes raise; these helpers use explicit casts,
``try_*`` parsers and ``get`` so that bad input gives null instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import RESTORED_PREFIX


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers ---------------------------------------------------------------

def round_half_up(c: str | Column, scale: int = 0) -> Column:
    """Round half away from zero (2.25 -> 2.3, -2.25 -> -2.3 at scale 1)."""
    return F.round(_c(c), scale)


def cube(c: str | Column) -> Column:
    x = _c(c).cast("double")
    return x * x * x


# --- text ------------------------------------------------------------------

def title_case(c: str | Column) -> Column:
    return F.initcap(_c(c))


def pad_left(c: str | Column, width: int, fill: str = " ") -> Column:
    """Left pad to ``width``; longer values are cut to ``width``."""
    return F.lpad(_c(c), width, fill)


def pad_right(c: str | Column, width: int, fill: str = " ") -> Column:
    return F.rpad(_c(c), width, fill)


def replace_pattern(c: str | Column, pattern: str, replacement: str) -> Column:
    """Replace every match of a Java regular expression."""
    return F.regexp_replace(_c(c), pattern, replacement)


def extract_group(c: str | Column, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match; '' when there is no match, null for null."""
    return F.regexp_extract(_c(c), pattern, group)


def words_of(c: str | Column, sep: str = " ") -> Column:
    return F.split(_c(c), sep)


# --- dates and times -------------------------------------------------------

def parse_timestamp(c: str | Column, fmt: str | None = None, ntz: bool = True) -> Column:
    """Text to timestamp; unparsable text gives null (not an error)."""
    col = _c(c)
    if ntz:
        return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz") if fmt else col.try_cast("timestamp_ntz")
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def format_timestamp(c: str | Column, fmt: str) -> Column:
    return F.date_format(_c(c), fmt)


def plus_minutes(c: str | Column, minutes: int) -> Column:
    """Timestamp plus a number of minutes (interval arithmetic, keeps the type)."""
    return _c(c) + F.make_dt_interval(mins=F.lit(minutes))


def plus_minutes_via_epoch(c: str | Column, minutes: int) -> Column:
    """Same through epoch seconds; result is text ``yyyy-MM-dd HH:mm:ss`` (second precision)."""
    return F.from_unixtime(F.unix_timestamp(_c(c)) + F.lit(minutes * 60))


def add_minutes_fn(minutes: int):
    """Factory closing over a constant: returns a Column function (a 'curried UDF')."""
    return lambda c: plus_minutes(c, minutes)


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_millis(c: str | Column, ntz: bool = True) -> Column:
    """Milliseconds since the epoch, rounded down (as ``unix_millis``).

    A TIMESTAMP_NTZ value is read as UTC wall-clock with NTZ arithmetic, so the
    result does not depend on the session time zone; ``ntz=False`` for TIMESTAMP.
    """
    col = _c(c)
    if not ntz:
        return F.unix_millis(col)
    micros = F.timestamp_diff("MICROSECOND", _epoch_ntz(), col)
    return ((micros - F.pmod(micros, F.lit(1000))) / F.lit(1000)).cast("long")


def diff_seconds(a: str | Column, b: str | Column) -> Column:
    return F.unix_timestamp(_c(a)) - F.unix_timestamp(_c(b))


def diff_millis(a: str | Column, b: str | Column, ntz: bool = True) -> Column:
    """a - b in milliseconds (each side rounded down to whole milliseconds first)."""
    return epoch_millis(a, ntz) - epoch_millis(b, ntz)


def truncate_to_millis(c: str | Column) -> Column:
    """Keep millisecond precision only (an instant stored as epoch ms) of a TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", epoch_millis(c), _epoch_ntz())


# --- arrays ----------------------------------------------------------------

def element(arr: str | Column, index: int) -> Column:
    """0-based element; null when out of range (plain ``[i]`` raises under ANSI)."""
    return F.get(_c(arr), index)


def zeros(n: str | Column) -> Column:
    """Array of ``n`` zeros (empty for n <= 0)."""
    return F.array_repeat(F.lit(0), _c(n).cast("int"))


# --- maps ------------------------------------------------------------------

def word_lengths(c: str | Column, sep: str = " ") -> Column:
    """Map word -> length over the distinct words of a text."""
    ws = F.array_distinct(F.split(_c(c), sep))
    return F.map_from_entries(F.transform(ws, lambda w: F.struct(w.alias("k"), F.length(w).alias("v"))))


def pair_map(k: str | Column, v: str | Column) -> Column:
    """One-entry map (null keys must be filtered first; they raise)."""
    return F.create_map(_c(k), _c(v))


# --- opaque values (custom column types) -------------------------------------

def to_bytes(c: str | Column, charset: str = "UTF-8") -> Column:
    return F.encode(_c(c), charset)


def restore_text(b: str | Column, prefix: str = RESTORED_PREFIX, charset: str = "UTF-8") -> Column:
    return F.concat(F.lit(prefix), F.decode(_c(b), charset))
