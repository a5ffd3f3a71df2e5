"""Scalar column helpers shared by every layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Unicode white-space characters, which a warehouse TRIM removes.
WHITESPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Share-class aliases rewritten to the seed's dotted form.
SHARE_CLASS_ALIASES = {"BRK-B": "BRK.B"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(n: Column | str, d: Column | str) -> Column:
    """NULL when the denominator is NULL or zero, else ``n / d``.

    Bare division by zero raises under ANSI mode, so the guard is explicit.
    """
    n, d = _c(n), _c(d)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(n / d)


def cents_to_dollars(c: Column | str, scale: int = 2) -> Column:
    return F.round(_c(c) / F.lit(100.0), scale)


def normalize_symbol(c: Column | str) -> Column:
    """``upper(trim(symbol))`` with Unicode-aware trimming."""
    return F.upper(F.btrim(_c(c), F.lit(WHITESPACE)))


def canonical_share_class(c: Column | str, aliases: Mapping[str, str] = SHARE_CLASS_ALIASES) -> Column:
    """Normalise a symbol, then map dashed share classes to the dotted form."""
    sym = normalize_symbol(c)
    out = None
    for src, dst in aliases.items():
        out = (F.when(sym == src, F.lit(dst)) if out is None else out.when(sym == src, F.lit(dst)))
    return sym if out is None else out.otherwise(sym)


def round_to_long(c: Column | str) -> Column:
    """Float -> INT64 rounding half away from zero (``cast`` alone truncates)."""
    return F.round(_c(c).cast("double")).cast("long")


def epoch_seconds_to_date(c: Column | str) -> Column:
    """Epoch seconds -> UTC calendar date, independent of the session zone."""
    return F.date_from_unix_date(F.floor(_c(c).cast("double") / F.lit(86400)).cast("int"))


def date_to_epoch_seconds(c: Column | str) -> Column:
    """Calendar date -> epoch seconds of its UTC midnight (request bounds)."""
    return F.unix_date(_c(c).cast("date")).cast("long") * F.lit(86400)


def utc_wall_clock(df: DataFrame, name: str) -> Column:
    """A timestamp column as UTC wall-clock ``timestamp_ntz``.

    Zoned timestamps (instants) are converted to UTC explicitly, so the result
    does not depend on the session time zone; zone-free timestamps already
    hold UTC wall-clock time and other types pass through.
    """
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), c)
    return c


def utc_date(df: DataFrame, name: str) -> Column:
    """The UTC calendar date of a timestamp (or the value of a date/text)."""
    return utc_wall_clock(df, name).cast("date")


def ntz_lit(value) -> Column:
    """A wall-clock ``timestamp_ntz`` literal from a naive datetime.

    ``F.lit(datetime)`` goes through the Python process's local zone and the
    session zone; building the literal from its text keeps it zone-free.
    """
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")))


def epoch_seconds_to_ts(c: Column | str) -> Column:
    """Epoch seconds -> UTC instant (``TimestampType``); NULL stays NULL."""
    return F.timestamp_seconds(_c(c).cast("long"))


# NULL placeholder and separator of the surrogate-key text form.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_text(c: Column | str) -> Column:
    """Explicit text form of a timestamp (engine-independent)."""
    return F.date_format(_c(c), TS_TEXT_FORMAT)


def surrogate_key(*cols: Column | str) -> Column:
    """NULL-safe md5 over the '-'-joined text form of the columns.

    Format timestamps with :func:`ts_text` first so the key does not depend on
    an engine's default timestamp rendering.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def col_or_null(df: DataFrame, name: str, dtype: T.DataType | str = "string") -> Column:
    """The column if the frame has it, else a typed NULL (schema drift)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast(dtype)
