"""File-source stream over landed raw candles -> incremental price fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators import price_state
from marketlake.sources.raw import read_raw, with_partition_fields


def refresh_batch(spark: SparkSession, batch: DataFrame, raw_root: str, raw_schema: T.StructType,
                  companies: DataFrame, target_path: str, state_path: str, tiebreak: Sequence[str] = ()) -> None:
    """One incremental run of the price fact for what a micro-batch landed.

    Touched symbols continue from the per-symbol state; the raw table gives
    the loads that the batch does not hold and the history of restated or
    unknown symbols.  The strict watermark and the keyed upsert make
    re-delivery of a batch harmless.
    """
    history = read_raw(spark, raw_root, "candles", schema=raw_schema)
    price_state.refresh_prices(spark, batch, history, companies, target_path, state_path,
                               [c for c in tiebreak if c in history.columns])


def start_price_refresh(spark: SparkSession, raw_root: str, raw_schema: T.StructType, companies: DataFrame,
                        target_path: str, checkpoint: str, state_path: str, available_now: bool = True,
                        tiebreak: Sequence[str] = ()) -> StreamingQuery:
    """Start the stream.

    ``checkpoint`` is the stream's folder for progress, the same one at every
    start; fact and state (``operators.price_state``) belong together.
    """
    full = with_partition_fields(raw_schema, "candles")
    source = (spark.readStream.schema(full).option("basePath", f"{raw_root}/candles")
              .parquet(f"{raw_root}/candles"))

    def run(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(spark, batch, raw_root, raw_schema, companies, target_path, state_path, tiebreak)

    writer = source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
