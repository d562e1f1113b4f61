"""The record scan over a growing folder of text or JSON lines; an extension, for continuous intake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..sources.scan import configure, json_text


def stream(spark: SparkSession, folder: str, json: bool, text_field: str = "text") -> DataFrame:
    """Streaming (text) of the lines of files that arrive in folder."""
    configure(spark)
    raw = spark.readStream.option("lineSep", "\n").text(folder).filter(F.is_valid_utf8("value"))
    value = F.regexp_replace("value", "\r$", "")
    if json:
        return raw.select(json_text(value, text_field)["text"].alias("text")).filter("text IS NOT NULL")
    return raw.select(value.alias("text")).filter(~is_blank(F.col("text")))
