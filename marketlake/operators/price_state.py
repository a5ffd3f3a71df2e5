"""Exact incremental price facts from a small per-symbol state.

A full incremental run recomputes every touched symbol's whole history (the
windows need it).  Here each symbol keeps, after every run, its last 19
staged rows (date, close, volume) and the running sum of log returns exactly
as the window accumulated it.  New loads are windowed after those context
rows, so lag, the 20-row statistics and the running sum continue with the
same inputs in the same order: the output equals a full recompute bit for
bit, while a run reads only the new loads plus 19 rows per symbol.

A symbol whose new loads touch a day at or before its state (a restatement)
or that has no state yet is recomputed from its full history instead.  The
state also keeps the newest load time it has seen, so a run finds what landed
since by itself; loads that a caller names count as new besides.  Without a
fact or a state every symbol is computed from its whole history, and every run
writes the state, so the two never drift apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.columns import normalize_symbol, ntz_lit, safe_divide, utc_date, utc_wall_clock
from marketlake.operators import incremental, staging, versions
from marketlake.operators.marts import FACT_PRICE_COLUMNS
from marketlake.operators.timeseries import ROLLING_ROWS, return_columns
from marketlake.session import scratch_path

TAIL = ROLLING_ROWS - 1

TAIL_ROW = T.StructType([T.StructField("date_key", T.DateType()), T.StructField("close", T.DoubleType()),
                         T.StructField("volume", T.LongType())])
STATE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("last_date", T.DateType()),
    T.StructField("log_sum", T.DoubleType()),
    T.StructField("tail", T.ArrayType(TAIL_ROW)),
    # newest load of any symbol that was there when this row was written
    T.StructField("loaded_to", T.TimestampNTZType()),
])


def feature_frame(rows: DataFrame) -> DataFrame:
    """Windows over staged rows; ``_ctx`` rows are state context whose
    ``_seed`` carries the stored running sum (first context row) or 0."""
    w = Window.partitionBy("symbol").orderBy("date_key")
    w20 = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
    daily, log_ret = return_columns()
    base = rows.select(
        "*",
        F.lag("close").over(w).alias("prev_close"),
        F.avg("volume").over(w20).alias("volume_sma_20"),
        F.stddev_pop("volume").over(w20).alias("volume_stddev_20"),
    )
    x = F.when(F.col("_ctx"), F.col("_seed")).otherwise(F.coalesce(log_ret, F.lit(0.0)))
    feats = base.select(
        "*", daily.alias("daily_return"), log_ret.alias("log_return"),
        safe_divide(F.col("volume") - F.col("volume_sma_20"),
                    F.nullif(F.col("volume_stddev_20"), F.lit(0.0))).alias("volume_zscore"),
        F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum_log"),
    )
    return feats.withColumn("cumulative_return", F.exp("_cum_log") - F.lit(1.0))


def state_of(frame: DataFrame) -> DataFrame:
    """Per symbol: last date, running log sum there, last ``TAIL`` rows."""
    w_desc = Window.partitionBy("symbol").orderBy(F.col("date_key").desc())
    ranked = frame.select("symbol", "date_key", "close", "volume", "_cum_log",
                          F.row_number().over(w_desc).alias("_rk")).where(F.col("_rk") <= TAIL)
    return ranked.groupBy("symbol").agg(
        F.max("date_key").alias("last_date"),
        F.max_by("_cum_log", "date_key").alias("log_sum"),
        # at most TAIL rows per symbol: a bounded list
        F.array_sort(F.collect_list(F.struct("date_key", "close", F.col("volume").cast("long").alias("volume"))))
        .alias("tail"),
    )


def _context_rows(state: DataFrame, loaded_type: T.DataType) -> DataFrame:
    t = state.select("symbol", "log_sum", F.posexplode("tail").alias("_pos", "t"))
    return t.select(
        "symbol", F.col("t.date_key").alias("date_key"),
        *[F.lit(None).cast("double").alias(c) for c in ("open", "high", "low")],
        F.col("t.close").alias("close"), F.col("t.volume").alias("volume"),
        F.lit(None).cast(loaded_type).alias("_loaded_at"),
        F.lit(True).alias("_ctx"),
        F.when(F.col("_pos") == 0, F.col("log_sum")).otherwise(F.lit(0.0)).alias("_seed"),
    )


def _as_new(stg: DataFrame) -> DataFrame:
    return stg.select("symbol", "date_key", "open", "high", "low", "close", "volume", "_loaded_at",
                      F.lit(False).alias("_ctx"), F.lit(None).cast("double").alias("_seed"))


def _new_loads(raw_history: DataFrame, new_raw: DataFrame | None, mark) -> DataFrame:
    """(symbol, day) of the loads since ``mark`` and of those the caller names."""
    def seen(raw: DataFrame) -> DataFrame:
        return raw.select(normalize_symbol("symbol").alias("symbol"), utc_date(raw, "trading_date").alias("day"))

    since = raw_history.where(utc_wall_clock(raw_history, "_loaded_at") > ntz_lit(mark)) if mark is not None \
        else raw_history.where(F.lit(False))
    return seen(since) if new_raw is None else seen(since).unionByName(seen(new_raw))


def refresh_prices(spark: SparkSession, new_raw: DataFrame | None, raw_history: DataFrame, companies: DataFrame,
                   target_path: str, state_path: str, tiebreak: Sequence[str] = (), from_history: bool = False,
                   rebuild: bool = False, staged: DataFrame | None = None, lookback_days: int = 0,
                   counts: Mapping[str, Column] | None = None) -> None:
    """One run of the daily price fact and its per-symbol state.

    ``raw_history`` is the whole raw table.  Symbols with loads newer than the
    state's mark, or in ``new_raw``, are touched: restated ones are computed
    from their whole history, the others from their state and the days after
    it.  With ``from_history``, or without a fact or a state, all symbols are
    computed from their whole history.  Rows newer than the fact's global
    strict watermark, less ``lookback_days``, are upserted; ``rebuild`` replaces
    the fact instead.  Within the look-back, rows that a symbol computed from its
    whole history no longer has are taken out.
    ``staged`` may give the staged rows of ``raw_history`` (they are then not
    staged again where all symbols are computed).  ``counts`` are taken of the
    fact's rows as they are written.
    """
    have_fact, have_state = versions.exists(spark, target_path), versions.exists(spark, state_path)
    everything = from_history or rebuild or not (have_fact and have_state)
    old_state = spark.createDataFrame([], STATE_SCHEMA) if everything else versions.read(spark, state_path, STATE_SCHEMA)
    tb = [c for c in tiebreak if c in raw_history.columns]
    loaded_to = raw_history.agg(F.max(utc_wall_clock(raw_history, "_loaded_at"))).first()[0]

    touched = full_syms = None
    if everything:
        stg = staging.stg_candles(raw_history, tiebreak=tb) if staged is None else staged
        frame = feature_frame(_as_new(stg))
    else:
        mark = old_state.agg(F.max("loaded_to")).first()[0]
        touched = (_new_loads(raw_history, new_raw, mark).where(F.col("symbol").isNotNull())
                   .groupBy("symbol").agg(F.min("day").alias("_min_new")))
        decided = touched.join(old_state.select("symbol", "last_date"), "symbol", "left")
        full_syms = decided.where(F.col("last_date").isNull() | (F.col("_min_new") <= F.col("last_date"))).select("symbol")
        inc_syms = decided.where(F.col("_min_new") > F.col("last_date")).select("symbol")
        hist = raw_history.join(full_syms, normalize_symbol(raw_history["symbol"]) == full_syms["symbol"], "left_semi")
        full_frame = feature_frame(_as_new(staging.stg_candles(hist, tiebreak=tb)))
        # Stateful symbols: stage every raw load dated after the symbol's state
        # (not only the new files), so the newest load wins exactly as in a full
        # recompute even if load clocks are out of order.  The literal bound
        # lets Parquet row-group statistics skip old files; the semi join then
        # applies each symbol's own bound.
        inc_state = old_state.join(inc_syms, "symbol", "left_semi").select(
            F.col("symbol").alias("__s"), F.col("last_date").alias("__last"))
        min_last = inc_state.agg(F.min("__last")).first()[0]
        day = utc_date(raw_history, "trading_date")
        recent = raw_history.where(day > F.lit(min_last).cast("date")) \
            if min_last is not None else raw_history.where(F.lit(False))
        recent = recent.join(inc_state, (normalize_symbol(recent["symbol"]) == F.col("__s"))
                             & (day > F.col("__last")), "left_semi")
        new_stg = staging.stg_candles(recent, tiebreak=tb)
        loaded_type = new_stg.schema["_loaded_at"].dataType
        inc_rows = _context_rows(old_state.join(inc_syms, "symbol", "left_semi"), loaded_type).unionByName(
            _as_new(new_stg))
        frame = full_frame.unionByName(feature_frame(inc_rows))

    # cut lineage once: the frame feeds both the fact rows and the new state
    frame_path = scratch_path(spark, "price-frame")
    frame.write.parquet(frame_path)
    frame = spark.read.schema(frame.schema).parquet(frame_path)

    rows = frame.where(~F.col("_ctx") & F.col("prev_close").isNotNull())
    fact = rows.join(companies.select("symbol", "sector"), "symbol", "left").select(*FACT_PRICE_COLUMNS)
    if not have_fact or rebuild:
        incremental.full_refresh(fact, target_path, "date_key", counts=counts)
    else:
        target = versions.read(spark, target_path, fact.schema)
        fresh = incremental.watermark_filter(fact, target, "date_key", lookback_days)
        replaced = incremental.watermark_filter(target, target, "date_key", lookback_days) if lookback_days else None
        if replaced is not None and full_syms is not None:
            replaced = replaced.join(full_syms, "symbol", "left_semi")
        incremental.keyed_upsert(spark, target_path, fresh, ["symbol", "date_key"], "date_key", fact.schema, replaced, counts)

    # touched symbols take their new state (none if no staged row is left)
    new_state = state_of(frame)
    kept = old_state.drop("loaded_to")
    if touched is not None:
        kept = kept.join(touched.select("symbol"), "symbol", "left_anti")
    mark = F.lit(None).cast("timestamp_ntz") if loaded_to is None else ntz_lit(loaded_to)
    versions.publish(kept.unionByName(new_state).withColumn("loaded_to", mark), state_path)
