"""Structured Streaming form of the incremental fact refresh.

The reference is batch only; its incremental model run (strict watermark +
keyed upsert) is what a file-triggered stream does here: new raw candle
files arrive, each micro-batch refreshes the daily price fact.
"""

from marketlake.streaming.price_refresh import start_price_refresh  # noqa: F401
