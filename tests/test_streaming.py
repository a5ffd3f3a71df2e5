import datetime as dt

from marketlake.operators import versions
from marketlake.plans import fixtures as fx
from marketlake.plans import registry as R
from marketlake.session import scratch_path
from marketlake.sources import writers as WR
from marketlake.sources.raw import read_raw
from marketlake.streaming import start_price_refresh
from marketlake.streaming.price_refresh import refresh_batch

SF = "/root/testdata/sf0.001"


def test_redelivered_batch_is_idempotent_and_restart_resumes(spark):
    raw = fx.fx_candles(spark, SF)
    star = R.star(spark, SF)
    root, target, ckpt = scratch_path(spark, "t-sraw"), scratch_path(spark, "t-sfact"), scratch_path(spark, "t-sckpt")
    state = scratch_path(spark, "t-sstate")
    WR.write_raw_partitioned(raw, root, "candles")
    q = start_price_refresh(spark, root, raw.schema, star.dim_companies, target, ckpt, state, tiebreak=["event_id"])
    q.awaitTermination()
    schema = star.fct_daily_prices.schema
    first = versions.read(spark, target, schema)
    n = first.count()
    assert n == star.fct_daily_prices.count()

    # at-least-once delivery: the same batch again changes nothing
    batch = read_raw(spark, root, "candles", schema=raw.schema)
    refresh_batch(spark, batch, root, raw.schema, star.dim_companies, target, state, tiebreak=["event_id"])
    again = versions.read(spark, target, schema)
    assert again.count() == n and again.exceptAll(star.fct_daily_prices).count() == 0

    # restart with the same checkpoint: no new files, no new batch
    q = start_price_refresh(spark, root, raw.schema, star.dim_companies, target, ckpt, state, tiebreak=["event_id"])
    q.awaitTermination()
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0
    assert versions.read(spark, target, schema).count() == n
