"""Flatten landed API payloads (JSON text) into raw rows (S-4..S-7).

Payloads arrive one per (symbol, request) as a JSON string column; parsing
is ``from_json`` with an explicit schema and rows come from ``inline`` /
``explode`` — no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.columns import epoch_seconds_to_date, epoch_seconds_to_ts

_D, _S, _L = T.DoubleType(), T.StringType(), T.LongType()

# Fixed values below: the JSON field names of the four API payloads (candle
# arrays, profile object, news items, financial metrics), as the API sends them.

CANDLE_PAYLOAD = T.StructType([
    T.StructField("s", _S),
    T.StructField("t", T.ArrayType(_L)),
    T.StructField("o", T.ArrayType(_D)),
    T.StructField("h", T.ArrayType(_D)),
    T.StructField("l", T.ArrayType(_D)),
    T.StructField("c", T.ArrayType(_D)),
    T.StructField("v", T.ArrayType(_D)),
])

PROFILE_PAYLOAD = T.StructType([T.StructField(n, _D if n == "marketCapitalization" else _S) for n in (
    "ticker", "name", "exchange", "finnhubIndustry", "country", "marketCapitalization", "logo", "ipo", "weburl")])

NEWS_ITEM = T.StructType([
    T.StructField("datetime", _L),
    *[T.StructField(n, _S) for n in ("headline", "summary", "source", "category", "url", "image")],
])

FIN_METRIC = T.StructType([T.StructField(n, _D) for n in (
    "peBasicExclExtraTTM", "pbAnnual", "epsTTM", "dividendYieldIndicatedAnnual", "beta",
    "52WeekHigh", "52WeekLow", "marketCapitalization")])
FIN_PAYLOAD = T.StructType([T.StructField("metric", FIN_METRIC)])

_ARRAYS = ["t", "o", "h", "l", "c", "v"]


def _loaded(loaded_at) -> Column:
    return loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)


def _non_empty_object(payload: Column) -> Column:
    """True for a JSON object with at least one key (a falsy ``{}`` or a
    NULL payload carries nothing)."""
    return _is_object(payload) & F.coalesce(F.size(F.json_object_keys(payload)) > 0, F.lit(False))


def _is_json(payload: Column) -> Column:
    return F.try_parse_json(payload).isNotNull()


def _is_object(payload: Column) -> Column:
    return _is_json(payload) & F.startswith(F.ltrim(payload), F.lit("{"))


def _is_list(payload: Column) -> Column:
    return _is_json(payload) & F.startswith(F.ltrim(payload), F.lit("["))


#: The form of each raw table's payload: its test and what a reject is called.
FORMS = {"candles": (_is_object, "not an object"), "company_profiles": (_is_object, "not an object"),
         "company_news": (_is_list, "not a list"), "company_financials": (_is_object, "not an object")}


def reject_reason(table: str, payload: Column) -> Column:
    """Why a payload is no answer for ``table``, NULL for one that is (or is NULL):
    a function of the payload alone, so rows are judged where they are."""
    return F.transform(F.array(payload), lambda body: _reason(table, body)).getItem(0)


def _reason(table: str, body: Column) -> Column:
    fits, name = FORMS[table]
    reason = F.when(~_is_json(body), "not JSON").when(~fits(body), name)
    if table == "candles":
        reason = reason.when(_candle_parts(body, lambda live, same, _: live & ~same), "unequal array lengths")
    return F.when(body.isNotNull(), reason)


def _candle_parts(payload: Column, made) -> Column:
    """``made(live, same, arrays)`` of a candle object, which is parsed once for all three:
    whether it has bars, whether its arrays are equally long, and the arrays."""

    def parts(p: Column) -> Column:
        arr = [F.coalesce(p.getField(a), F.array().cast(T.ArrayType(_L if a == "t" else _D))) for a in _ARRAYS]
        same = F.lit(True)
        for e in arr[1:]:
            same = same & (F.size(e) == F.size(arr[0]))
        return made(p.isNotNull() & (F.coalesce(p.getField("s"), F.lit("")) != "no_data"), same, arr)

    # The lambda's variable keeps the optimizer from parsing once for each field.
    return F.transform(F.array(F.from_json(payload, CANDLE_PAYLOAD)), parts).getItem(0)


def rejected(payloads: DataFrame, table: str, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """(table, symbol, payload, reason) of the payloads that are no answer for
    ``table``: bodies that are not JSON (cut off, an error page), have another
    form or, for candles, arrays of unequal lengths.  A NULL payload is no answer to reject."""
    # One generator: a filter on the reason would have the payload, which may be long in the making, made again for each mention of it.
    judged = F.transform(F.array(F.col(payload)), lambda body: F.named_struct(F.lit("payload"), body, F.lit("reason"), _reason(table, body)))
    return payloads.select(F.lit(table).alias("table"), F.col(symbol).alias("symbol"), F.inline(F.filter(judged, lambda r: r["reason"].isNotNull())))


def flatten_candles(payloads: DataFrame, loaded_at, symbol: str = "symbol",
                    payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """S-4: parallel arrays -> one row per bar.

    Returns ``(rows, rejects)``.  NULL/empty payloads and ``s = no_data``
    give no rows; payloads that are not a JSON object, or whose arrays differ
    in length (``arrays_zip`` would pad with NULLs instead), are rejected whole.
    """
    body = F.col(payload)
    bars = F.when(_is_object(body), _candle_parts(body, lambda live, same, arr: F.when(live & same, F.arrays_zip(*arr))))
    rows = (
        payloads.select(F.col(symbol).alias("symbol"), F.inline(bars).alias(*_ARRAYS))
        .select(
            "symbol",
            epoch_seconds_to_date("t").alias("trading_date"),
            F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"),
            F.col("c").alias("close"), F.col("v").alias("volume"),
            _loaded(loaded_at).alias("_loaded_at"),
        )
    )
    return rows, rejected(payloads, "candles", symbol, payload).drop("table")


def flatten_profiles(payloads: DataFrame, loaded_at, payload: str = "payload") -> DataFrame:
    """S-5: profile object -> one row; payloads without a ticker are skipped."""
    p = payloads.where(_is_object(F.col(payload))).select(F.from_json(F.col(payload), PROFILE_PAYLOAD).alias("p"))
    return p.where(F.col("p.ticker").isNotNull() & (F.col("p.ticker") != "")).select(
        F.col("p.ticker").alias("symbol"),
        F.col("p.name").alias("company_name"),
        F.col("p.exchange").alias("exchange"),
        F.col("p.finnhubIndustry").alias("industry"),
        F.col("p.country").alias("country"),
        F.col("p.marketCapitalization").alias("market_cap"),
        F.col("p.logo").alias("logo_url"),
        F.col("p.ipo").alias("ipo_date"),
        F.col("p.weburl").alias("web_url"),
        _loaded(loaded_at).alias("_loaded_at"),
    )


def flatten_news(payloads: DataFrame, loaded_at, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """S-6: list of news objects -> one row each; epoch seconds -> UTC
    timestamp, a NULL time stays NULL.  A payload that is not a JSON list
    (an error object) yields nothing."""
    items = F.when(_is_list(F.col(payload)), F.from_json(F.col(payload), T.ArrayType(NEWS_ITEM)))
    return (
        payloads.select(F.col(symbol).alias("symbol"), F.explode(items).alias("n"))
        .where(F.col("n").isNotNull())
        .select(
            "symbol",
            epoch_seconds_to_ts("n.datetime").alias("datetime"),
            *[F.col(f"n.{c}").alias(c) for c in ("headline", "summary", "source", "category", "url", "image")],
            _loaded(loaded_at).alias("_loaded_at"),
        )
    )


def flatten_financials(payloads: DataFrame, loaded_at, symbol: str = "symbol",
                       payload: str = "payload") -> DataFrame:
    """S-7: ``metric`` object -> one row.  A present payload without
    ``metric`` still gives a row of NULLs; NULL or ``{}`` gives none."""
    m = F.from_json(F.col(payload), FIN_PAYLOAD).getField("metric")
    return payloads.where(_non_empty_object(F.col(payload))).select(
        F.col(symbol).alias("symbol"),
        m.getField("peBasicExclExtraTTM").alias("pe_ratio"),
        m.getField("pbAnnual").alias("pb_ratio"),
        m.getField("epsTTM").alias("eps_ttm"),
        m.getField("dividendYieldIndicatedAnnual").alias("dividend_yield"),
        m.getField("beta").alias("beta"),
        m.getField("52WeekHigh").alias("week_52_high"),
        m.getField("52WeekLow").alias("week_52_low"),
        m.getField("marketCapitalization").alias("market_cap"),
        _loaded(loaded_at).alias("_loaded_at"),
    )
