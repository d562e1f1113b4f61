"""Column expressions on names, lines and words; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the public GPT-2 splitting pattern, with Unicode-aware classes.
PRETOKEN = r"(?U)('s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"
SHARD_NAME = r"(?i)\.(jsonl|ndjson|txt|text)(\.gz)?$"


def is_shard(name: Column) -> Column:
    return name.rlike(SHARD_NAME)


def is_gzip(name: Column) -> Column:
    return F.lower(name).endswith(".gz")


def is_json(name: Column) -> Column:
    base = F.regexp_replace(F.lower(name), r"\.gz$", "")
    return base.endswith(".jsonl") | base.endswith(".ndjson")


def is_blank(line: Column) -> Column:
    """Only Unicode white space, or nothing."""
    return line.rlike(r"(?U)^\s*$")


def pretokens(text: Column) -> Column:
    """The words of a text; joined they give it back."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN), F.lit(1))


def symbols(word: Column) -> Column:
    """A word as bytes, each <XX>: replacing '<a><b>' by '<ab>' is one merge of byte pairs."""
    return F.regexp_replace(F.hex(F.encode(word, "UTF-8")), "(..)", "<$1>")


def symbol_list(word: Column) -> Column:
    return F.split(F.substring(word, F.lit(2), F.length(word) - 2), "><")


def format_bytes(value: Column) -> Column:
    """B without decimals, KiB to TiB with one; ties round to even."""
    out = F.concat(value.cast("string"), F.lit(" B"))
    for power, unit in ((1, "KiB"), (2, "MiB"), (3, "GiB"), (4, "TiB")):
        scaled = F.bround(value.cast("double") / float(1024**power), 1)
        # Plain digits: the string form of a large double would have an exponent.
        shown = F.concat(scaled.cast("decimal(20,1)").cast("string"), F.lit(f" {unit}"))
        out = F.when(value >= 1024**power, shown).otherwise(out)
    return out
