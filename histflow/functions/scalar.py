"""Scalar column functions: codes, dates, casts, text, hashes, ids.

All of them are compositions of Spark's own functions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, functions as F, types as T

from histflow import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- codes and routes --------------------------------------------------------


def code_map(col: Column | str, codes: dict[str, str], ignore_case: bool = False) -> Column:
    """Replace known codes; unknown text passes through unchanged."""
    col = _col(col)
    pairs = {k.upper(): v for k, v in codes.items()} if ignore_case else codes
    lookup = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(lookup[F.upper(col) if ignore_case else col], col)


def first_match(cases: Sequence[tuple[Column, Column]]) -> Column:
    """The value of the first case whose condition holds, else NULL."""
    (condition, value), *rest = cases
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain


def routed_field(selector: Column | str, routes: dict[str, Column]) -> Column:
    """Pick a value by the text of ``selector``; no route means NULL."""
    selector = _col(selector)
    return first_match([(selector == key, value) for key, value in routes.items()])


# --- constants, defaults, casts ------------------------------------------------


def typed_null(data_type: T.DataType | str) -> Column:
    return F.lit(None).cast(data_type)


def low_date() -> Column:
    return F.lit(fv.LOW_DATE).cast("date")


def high_date() -> Column:
    return F.lit(fv.HIGH_DATE).cast("date")


def open_end(data_type: T.DataType | str = "timestamp") -> Column:
    return F.lit(fv.OPEN_END).cast(data_type)


def default_date(col: Column | str, default: Column) -> Column:
    return F.coalesce(_col(col), default)


def safe_cast(col: Column | str, data_type: T.DataType | str) -> Column:
    """Cast, or NULL where the text is not a value of the type.

    Spark's text casts are more lenient than standard SQL for some types
    (``'t'`` as a boolean, ``'2025'`` as a date, ``'10:00'`` as a timestamp of
    today), so the text must look like a whole value first. For numbers the
    same look avoids the cost of a failing cast.
    """
    col = _col(col)
    if isinstance(data_type, str):
        data_type = T.DataType.fromDDL(data_type)
    if isinstance(data_type, T.BooleanType):
        return F.when(F.lower(col.cast("string")).isin("true", "false"), col.try_cast(data_type))
    if isinstance(data_type, T.DateType):
        shape = r"^\s*\d{1,4}-\d{1,2}-\d{1,2}\s*$"
        return F.when(col.cast("string").rlike(shape), col.try_cast(data_type))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        shape = r"^\s*\d{1,4}-\d{1,2}-\d{1,2}"
        instant = col.try_cast("timestamp").cast(data_type)
        return F.when(col.cast("string").rlike(shape), instant)
    if isinstance(data_type, T.IntegralType):
        return F.when(col.cast("string").rlike(r"^\s*[+-]?\d+\s*$"), col.try_cast(data_type))
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        # a type suffix (1.5d) is no part of a number
        shape = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
        return F.when(col.cast("string").rlike(shape), col.try_cast(data_type))
    return col.try_cast(data_type)


def date_of_instant(col: Column | str) -> Column:
    """The (session zone) day of a timestamp text, NULL where it is none."""
    return F.to_date(safe_cast(col, T.TimestampType()))


AsOf = Column | datetime | str | None


def as_instant(as_of: AsOf) -> Column:
    """The run time: a column, a literal, or by default the statement's clock."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def previous_midnight(as_of: Column, data_type: T.DataType | str = "timestamp") -> Column:
    """Midnight at the start of the day before ``as_of``."""
    return F.date_sub(F.to_date(as_of), 1).cast(data_type)


# --- text ------------------------------------------------------------------------


def decode_ampersand(col: Column | str) -> Column:
    return F.regexp_replace(_col(col), fv.AMPERSAND_PATTERN, "&")


def clean_key(col: Column | str) -> Column:
    """Letters, digits and spaces only; then each run of spaces becomes ``_``."""
    letters = F.regexp_replace(_col(col), fv.KEY_NOISE_PATTERN, "")
    return F.regexp_replace(letters, fv.SPACES_PATTERN, "_")


def underscore_spaces(col: Column) -> Column:
    return F.regexp_replace(col, fv.SPACES_PATTERN, "_")


def trim_all(col: Column) -> Column:
    return F.btrim(col, F.lit(fv.WHITESPACE))


def split_list(col: Column | str, separator: str = ";") -> Column:
    """Separated text -> trimmed, non-empty elements."""
    parts = F.split(_col(col), re.escape(separator))
    return F.filter(F.transform(parts, trim_all), lambda v: v != "")


def level_number(col: Column | str) -> Column:
    """The first run of digits as a number, NULL where there is none."""
    digits = F.regexp_extract(_col(col), fv.DIGITS_PATTERN, 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


# --- keys and hashes ----------------------------------------------------------------


def key_text(cols: Sequence[Column | str], null_text: str | None = fv.NULL_TEXT) -> Column:
    """``a|b|c``; NULLs read as ``null_text``, or are left out if that is None."""
    parts = [_col(c).cast("string") for c in cols]
    if null_text is not None:
        parts = [F.coalesce(p, F.lit(null_text)) for p in parts]
    return F.concat_ws("|", *parts)


def md5_key(cols: Sequence[Column | str], null_text: str | None = fv.NULL_TEXT) -> Column:
    return F.md5(key_text(cols, null_text))


def sha256_key(col: Column | str) -> Column:
    return F.sha2(_col(col).cast("string"), 256)


def joined_key(cols: Sequence[Column | str], separator: str = "-") -> Column:
    """Key text that is NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.lit(separator), _col(c).cast("string")]
    return F.concat(*parts[1:])


def content_digest(cols: Sequence[Column | str]) -> Column:
    """A digest that differs as soon as one column does, NULLs included.

    Each value carries its length, so neither a separator inside a value nor a
    NULL can make two different rows look alike.
    """
    parts = []
    for c in cols:
        text = _col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def surrogate_key(cols: Sequence[Column | str], as_of: Column) -> Column:
    """A row id that stays the same when a lost task is computed again.

    Different values give different ids: NULL and the separator included.
    """
    return content_digest([*cols, as_of])


def random_key() -> Column:
    """A random id. Write the rows once before using them twice."""
    return F.expr("uuid()")
