"""Landed API responses: one JSON file for each symbol and request.

A run's folder holds ``candles/``, ``fallback_candles/``, ``profiles/``,
``news/`` and ``financials/`` with files named ``<symbol>.json`` (the symbol
percent-encoded where it needs to be).  The HTTP client that puts them there is
not part of the library.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = "symbol string, payload string"


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(symbol, payload) of every file in ``folder``; a folder that is not there is empty."""
    try:
        files = spark.read.text(folder, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PAYLOAD_SCHEMA)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    return files.select(F.url_decode(name).alias("symbol"), F.col("value").alias("payload"))


def denied_symbols(payloads: DataFrame) -> DataFrame:
    """(symbol) of the responses that refuse access: an object whose ``error`` says so."""
    said = F.lower(F.coalesce(F.get_json_object("payload", "$.error"), F.lit("")))
    refused = said.contains("access") | said.contains("permission") | said.contains("denied") | said.contains("403")
    return payloads.where(refused).select("symbol").distinct()
