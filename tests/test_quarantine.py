import datetime as dt
import json

from pyspark.sql import functions as F

from marketlake.session import scratch_path
from marketlake.sources import quarantine as Q
from marketlake.sources.raw import read_raw
from tests.conftest import rows

AT = int(dt.datetime(2024, 1, 9, tzinfo=dt.timezone.utc).timestamp())
BARS = json.dumps({"s": "ok", "t": [AT], **{c: [1.0] for c in "ohlcv"}})


def test_reject_mend_replay(spark):
    root = scratch_path(spark, "t-quarantine")
    reject = lambda *r: spark.createDataFrame(list(r), "table string, symbol string, payload string, reason string")
    assert Q.open_rejects(spark, root).count() == 0
    Q.quarantine(reject(("candles", "A", BARS[:-3], "not JSON"), ("candles", "A", BARS[:-3], "not JSON"), ("candles", "B", "<html>", "not JSON")), root, "r1")
    Q.quarantine(reject(("company_news", "A", '{"error":"x"}', "not a list"), ("company_profiles", None, "{", "not JSON")), root, "r2")
    Q.quarantine(reject(("company_news", "A", '{"error":"x"}', "not a list")), root, "r2")  # the run repeated
    assert rows(Q.open_rejects(spark, root), "run", "table", "symbol") == [("r1", "candles", "A"), ("r1", "candles", "A"), ("r1", "candles", "B"), ("r2", "company_news", "A")]
    mend = lambda df: df.withColumn("payload", F.when(F.col("symbol") == "A", F.when(F.col("table") == "candles", F.lit(BARS)).otherwise(F.lit(None).cast("string")))
                                    .otherwise(F.col("payload")))
    Q.replay(spark, root, root, mend, dt.date(2024, 1, 10), dt.datetime(2024, 1, 10), "one")
    assert rows(Q.open_rejects(spark, root), "run", "symbol") == [("r1", "B"), ("r2", "A")]
    got = read_raw(spark, root, "candles")
    assert rows(got, "symbol", "trading_date", "day") == [("A", dt.date(2024, 1, 9), 10)] * 2  # two loads, of which staging keeps one
    Q.replay(spark, root, root, mend, dt.date(2024, 1, 11), dt.datetime(2024, 1, 11), "two")
    assert got.count() == 2 and rows(Q.open_rejects(spark, root), "symbol") == [("A",), ("B",)]
    Q.quarantine(reject(), root, "r1")  # a later repeat of the run without rejects
    assert rows(Q.open_rejects(spark, root), "run") == [("r2",)]


def test_a_payload_is_made_once_to_be_judged(spark):
    made = F.regexp_replace("payload", "#", "")
    bodies = spark.createDataFrame([("A", BARS + "#"), ("B", BARS.replace("[1.0]", "[]", 1)), ("C", "<html>"), ("D", None), ("E", "[]")], "symbol string, payload string")
    rows_, rejects = Q.payloads.flatten_candles(bodies.select("symbol", made.alias("payload")), F.lit(dt.datetime(2024, 1, 9)))
    assert rows(rejects, "symbol", "reason") == [("B", "unequal array lengths"), ("C", "not JSON"), ("E", "not an object")] and rows(rows_, "symbol") == [("A",)]
    plan = rejects._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.count("from_json") <= 1
