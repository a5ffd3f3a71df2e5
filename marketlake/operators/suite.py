"""The declared data tests of every model, run as one summary (D-1..D-8).

Row-level tests of a model (not_null, accepted_values, between, the two
singular assertions) are answered in one pass with ``count_if`` /
``count_distinct``, or without any from the counts taken while the model was
written (``row_counts``, ``operators.versions``); uniqueness tests are one
grouped count each; each relationship test is one anti join.  Result: one row
per test with its failure count, like a test run's summary.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.sectors import SECTORS
from marketlake.operators import versions

# The tests declared per model, as (model, test, column(s), argument).
DECLARED_TESTS = [
    ("stg_candles", "unique_combination", ("symbol", "date_key"), None),
    ("stg_candles", "not_null", "symbol", None),
    ("stg_candles", "not_null", "date_key", None),
    ("stg_candles", "not_null", "close", None),
    ("stg_candles", "not_null", "volume", None),
    ("stg_company_profiles", "not_null", "symbol", None),
    ("stg_company_profiles", "unique", "symbol", None),
    ("stg_company_profiles", "not_null", "sector", None),
    ("stg_company_profiles", "accepted_values", "sector", "sectors"),
    ("stg_company_news", "not_null", "symbol", None),
    ("stg_company_news", "not_null", "news_ts", None),
    ("stg_company_financials", "unique_combination", ("symbol", "date_key"), None),
    ("stg_company_financials", "not_null", "symbol", None),
    ("stg_company_financials", "not_null", "date_key", None),
    ("int_daily_returns", "not_null", "symbol", None),
    ("int_daily_returns", "not_null", "date_key", None),
    ("int_daily_returns", "not_null", "daily_return", None),
    ("int_volume_stats", "unique_combination", ("symbol", "date_key"), None),
    ("int_volume_stats", "not_null", "symbol", None),
    ("int_volume_stats", "not_null", "date_key", None),
    ("dim_companies", "not_null", "symbol", None),
    ("dim_companies", "unique", "symbol", None),
    ("dim_companies", "not_null", "sector", None),
    ("dim_companies", "accepted_values", "sector", "sectors"),
    ("dim_dates", "not_null", "date_key", None),
    ("dim_dates", "unique", "date_key", None),
    ("fct_daily_prices", "unique_combination", ("symbol", "date_key"), None),
    ("fct_daily_prices", "not_null", "symbol", None),
    ("fct_daily_prices", "relationships", "symbol", ("dim_companies", "symbol")),
    ("fct_daily_prices", "not_null", "date_key", None),
    ("fct_daily_prices", "relationships", "date_key", ("dim_dates", "date_key")),
    ("fct_daily_prices", "not_null", "close", None),
    ("fct_daily_prices", "between", "close", (0, 100000)),
    ("fct_daily_prices", "not_null", "volume", None),
    ("fct_company_news", "not_null", "news_id", None),
    ("fct_company_news", "unique", "news_id", None),
    ("fct_company_news", "not_null", "symbol", None),
    ("fct_company_news", "relationships", "symbol", ("dim_companies", "symbol")),
    ("fct_company_news", "not_null", "date_key", None),
    ("fct_company_news", "relationships", "date_key", ("dim_dates", "date_key")),
    ("fct_company_financials", "unique_combination", ("symbol", "date_key"), None),
    ("fct_company_financials", "not_null", "symbol", None),
    ("fct_company_financials", "relationships", "symbol", ("dim_companies", "symbol")),
    ("fct_company_financials", "not_null", "date_key", None),
    ("fct_company_financials", "relationships", "date_key", ("dim_dates", "date_key")),
    ("sector_performance", "not_null", "date_key", None),
    ("sector_performance", "not_null", "sector", None),
    ("sector_performance", "not_null", "cumulative_return", None),
    ("sector_volatility", "not_null", "sector", None),
    ("sector_volatility", "unique", "sector", None),
    ("sector_volatility", "not_null", "annualized_volatility", None),
    ("fct_daily_prices", "assert_positive_volume", "volume", None),
    ("fct_daily_prices", "assert_valid_return_range", "daily_return", None),
]

_ROW_TESTS = {"not_null", "accepted_values", "between", "assert_positive_volume", "assert_valid_return_range"}


def _col_name(cols) -> str:
    return ",".join(cols) if isinstance(cols, tuple) else cols


def _metric(test: str, col: str, arg, accepted) -> str:
    """A test's name among the kept counts: one that is declared anew is another."""
    bound = sorted(accepted) if test == "accepted_values" else arg
    return f"{test}({col})" if bound is None else f"{test}({col}, {bound})"


def row_counts(model: str, tests=DECLARED_TESTS, accepted=SECTORS) -> dict[str, F.Column]:
    """The model's row tests as counts of failing rows that add up over the
    parts of a table, for the write that makes it."""
    return {_metric(t, c, a, accepted): _failing_rows(t, c, a, accepted) for m, t, c, a in tests if m == model and t in _ROW_TESTS}


def _failing_rows(test: str, col: str, arg, accepted) -> F.Column:
    if test == "accepted_values":
        return F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(accepted)))
    return _row_failure(test, col, arg, accepted)


def _row_failure(test: str, col: str, arg, accepted) -> F.Column:
    c = F.col(col)
    if test == "not_null":
        return F.count_if(c.isNull())
    if test == "accepted_values":
        # one failing row per distinct unaccepted value (NULL passes)
        return F.count_distinct(F.when(c.isNotNull() & ~c.isin(list(accepted)), c))
    if test == "between":
        return F.count_if(~c.between(arg[0], arg[1]))
    if test == "assert_positive_volume":
        return F.count_if(c <= 0)
    if test == "assert_valid_return_range":
        return F.count_if(F.abs(c) > 0.5)
    raise ValueError(test)


def _row(model: str, test: str, col: str, failures: F.Column) -> list[F.Column]:
    return [F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(col).alias("column_name"),
            failures.cast("long").alias("failures")]


def run_quality_suite(tables: Mapping[str, DataFrame], tests=DECLARED_TESTS, accepted=SECTORS,
                      written: Mapping[str, str] | None = None) -> DataFrame:
    """Failure count per declared test over the given model tables.

    Models missing from ``tables`` (e.g. news when disabled) are skipped.
    ``written`` has the paths of models that are tables of versions: their row
    tests are answered by the counts kept when they were written (a rejected
    value is looked up in the rows only if there is one).
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list] = {}
    for model, test, cols, arg in tests:
        if model in tables:
            by_model.setdefault(model, []).append((test, cols, arg))
    for model, ts in by_model.items():
        df = tables[model]
        row_tests = [(t, c, a) for t, c, a in ts if t in _ROW_TESTS]
        if row_tests and model in (written or {}):
            kept = versions.counted(df.sparkSession, written[model], df.schema, row_counts(model, tests, accepted))
            known, row_tests = row_tests, []
            answers = []
            for t, c, a in known:
                failing = kept[_metric(t, c, a, accepted)]
                if failing and t == "accepted_values":
                    row_tests.append((t, c, a))
                else:
                    answers.append((model, t, c, failing))
            parts.append(df.sparkSession.createDataFrame(answers, "model string, test string, column_name string, failures long"))
        if row_tests:
            aggs = [_row_failure(t, c, a, accepted).alias(f"f{i}") for i, (t, c, a) in enumerate(row_tests)]
            wide = df.agg(*aggs)
            # one pass over the model, then one output row per test
            stacked = F.array(*[F.struct(*_row(model, t, c, F.col(f"f{i}")))
                                for i, (t, c, a) in enumerate(row_tests)])
            parts.append(wide.select(F.inline(stacked)))
        for test, cols, arg in ts:
            if test in ("unique", "unique_combination"):
                keys = list(cols) if isinstance(cols, tuple) else [cols]
                src = df.where(F.col(keys[0]).isNotNull()) if test == "unique" else df
                dup = src.groupBy(*keys).count().where(F.col("count") > 1)
                parts.append(dup.agg(*_row(model, test, _col_name(cols), F.count(F.lit(1)))))
            elif test == "relationships":
                parent_model, parent_col = arg
                if parent_model not in tables:
                    continue
                parent = tables[parent_model].select(F.col(parent_col).alias("__pk"))
                orphans = df.where(F.col(cols).isNotNull()).join(parent, F.col(cols) == F.col("__pk"), "left_anti")
                parts.append(orphans.agg(*_row(model, test, cols, F.count(F.lit(1)))))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))
