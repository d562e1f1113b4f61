"""From shard files to records (file_ord, pos, text).

A byte order mark at the start of a file is not part of its first line, as
Spark's reader has it. A carriage return at the end of a line is dropped, also
of a last line without a line end.
"""

from __future__ import annotations

import gzip
import json
import logging
import os
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from ..staging import exists
from .files import detect_format

log = logging.getLogger(__name__)
LINES = "file_ord int, pos struct<a:bigint,b:bigint>, value string"


class Drops:
    """Counts what a scan leaves out, while it runs: no pass of its own, and no line comes to the driver.

    Give one to ``records``, run one action on the whole result, then ask.
    """

    def __init__(self) -> None:
        self._watched: list[Observation] = []
        self._files: list[str] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        seen = Observation()
        self._watched.append(seen)
        return df.observe(seen, *(c.alias(name) for name, c in counts.items()))

    def counts(self) -> dict[str, int]:
        """lines, and of these not_utf8, blank, malformed and textless; files that were not there, or gave no line."""
        out = dict.fromkeys(("lines", "not_utf8", "blank", "malformed", "textless"), 0)
        with_lines: set[int] = set()
        for seen in self._watched:
            for name, value in seen.get.items():
                if name == "files":
                    with_lines.update(value)
                else:
                    out[name] += value
        return out | {"silent_files": len(set(range(len(self._files))) - with_lines)}

    def warn(self) -> None:
        """Says in the log what was left out; blank lines are nothing to warn of."""
        for name, n in self.counts().items():
            if n and name not in ("lines", "blank", "textless"):
                log.warning("skipped %d %s", n, name.replace("_", " "))


def _hidden(spark: SparkSession, paths: list[tuple[int, str]]) -> DataFrame:
    """Lines of files whose names Spark's readers skip (leading _ or .); read where all executors see them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ord_, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with (gzip.open if detect_format(path).gzip else open)(path, "rb") as f:
                    rows: list[tuple[int, bytes]] = []
                    for n, line in enumerate(f):
                        rows.append((n, (line if n else line.removeprefix(b"\xef\xbb\xbf")).removesuffix(b"\n")))
                        if len(rows) == 10_000:
                            yield _batch(ord_, rows)
                            rows = []
                    yield _batch(ord_, rows)

    def _batch(ord_: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        pos = pa.StructArray.from_arrays([pa.array([0] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64())], ["a", "b"])
        return pa.RecordBatch.from_arrays(
            [pa.array([ord_] * len(rows), pa.int32()), pos, pa.array([r[1] for r in rows], pa.binary())], ["file_ord", "pos", "raw"]
        )

    made = spark.createDataFrame(paths, "ord int, path string").repartition(len(paths)).mapInArrow(
        run, "file_ord int, pos struct<a:bigint,b:bigint>, raw binary"
    )
    return made.select("file_ord", "pos", F.col("raw").cast("string").alias("value"))


_SCHEME = "[a-zA-Z][a-zA-Z0-9+.-]*:"


def _location(path: str) -> str:
    """A path of this machine or of another file system, without scheme and host; relative paths made absolute."""
    found = re.match(_SCHEME + r"(?://[^/]*)?(/.*)", path, re.S)
    return found[1] if found else os.path.abspath(path)


def _uris(paths: list[str], listed: list[str]) -> list[tuple[int, str]]:
    """(position in paths, URI as Spark names the file) of every file that is there."""
    by_place: dict[str, list[str]] = {}
    for uri in listed:
        by_place.setdefault(unquote(urlsplit(uri).path), []).append(uri)
    out = []
    for i, p in enumerate(paths):
        found = by_place.get(_location(p), [])
        # Two file systems may have a file of one path: then the one named.
        out += [(i, u) for u in found if len(found) == 1 or unquote(u).startswith(p.split("/", 3)[0])]
    return out


def lines(spark: SparkSession, paths: list[str], skip_corrupt: bool = True, drops: Drops | None = None) -> DataFrame:
    """Lines of files in order of (file_ord, pos): ends at \\n, one \\r before it dropped.

    Gzip is undone, also of several members. Lines that are no UTF-8 are dropped; of a broken file the readable
    part is kept, and a missing one is skipped. A path given twice is read once, at its first position.
    """
    place = lambda p: p if re.match(_SCHEME, p) else "file://" + quote(os.path.abspath(p), safe="/")
    paths_ = [p for p in dict.fromkeys(paths) if exists(spark, place(p))]
    at = {p: paths.index(p) for p in paths_}
    hidden = [(at[p], p) for p in paths_ if p.rsplit("/", 1)[-1][:1] in ("_", ".")]
    plain = [p for p in paths_ if p.rsplit("/", 1)[-1][:1] not in ("_", ".")]
    out = None
    if plain:
        flag = str(skip_corrupt).lower()
        read = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", flag).option("ignoreMissingFiles", flag)
        # Spark's own working folder may be another than this process has.
        found = read.text([p if re.match(_SCHEME, p) else os.path.abspath(p) for p in plain])
        order = spark.createDataFrame([(at[plain[i]], re.sub("^file:/+", "file:/", u)) for i, u in _uris(plain, found.inputFiles())], "file_ord int, uri string")
        raw = found.select(
            "value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("uri"), F.col("_metadata.file_block_start").alias("a"),
            F.monotonically_increasing_id().alias("b"),
        )
        out = raw.join(order, "uri").select("file_ord", F.struct("a", "b").alias("pos"), "value")
    if hidden:
        more = _hidden(spark, hidden)
        out = more if out is None else out.unionByName(more)
    if out is None:
        raise FileNotFoundError("no files to read")
    if drops:
        out = drops.watch(out, lines=F.count(F.lit(1)), not_utf8=F.count_if(~F.is_valid_utf8("value")))
    return out.filter(F.is_valid_utf8("value")).withColumn("value", F.regexp_replace("value", "\r$", ""))


def _path(field: str) -> str:
    """A field as a literal key, not a path."""
    if '"' not in field:
        return f'$["{field}"]'
    if "'" not in field:
        return f"$['{field}']"
    raise ValueError(f"a field with both kinds of quotes: {field}")


def json_text(line: Column, field: str = "text") -> Column:
    """struct(text, malformed) of a JSON line: text only where the field is a string that isn't empty."""
    parsed = F.try_parse_json(line)
    got = F.try_variant_get(parsed, _path(field), "variant")
    is_string = F.schema_of_variant(got) == "STRING"
    value = F.when(is_string, F.try_variant_get(parsed, _path(field), "string"))
    return F.struct(F.when(F.length(value) > 0, value).alias("text"), (parsed.isNull() & ~is_blank(line)).alias("malformed"))


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("malformed", T.BooleanType())]))
def _strict(line: pd.Series, field: pd.Series) -> pd.DataFrame:
    def one(x: str, key: str) -> tuple[str | None, bool]:
        if not x.strip():
            return None, False
        try:
            root = json.loads(x, parse_constant=_refuse, parse_float=_finite)
            value = root.get(key) if isinstance(root, dict) else None
            if isinstance(value, str):
                value.encode("utf-8")
            _depth(root)
        except (ValueError, RecursionError):
            return None, True
        return (value if isinstance(value, str) and value else None), False

    rows = [one(x, k) for x, k in zip(line, field, strict=True)]
    return pd.DataFrame(rows, columns=["text", "malformed"])


def _refuse(name: str) -> None:
    raise ValueError(name)


def _finite(x: str) -> float:
    v = float(x)
    if v in (float("inf"), float("-inf")):
        raise ValueError("a number out of range")
    return v


def _depth(x: object, left: int = 128) -> None:
    if left == 0:
        raise ValueError("nested too deeply")
    for y in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
        _depth(y, left - 1)


def json_text_strict(line: Column, field: str = "text") -> Column:
    """The same, with a parser that also refuses trailing characters, numbers out of range and lone surrogates."""
    return _strict(line, F.lit(field))


def configure(spark: SparkSession) -> None:
    """Of a repeated key the last one counts."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def records(
    spark: SparkSession, paths: list[str], text_field: str = "text", strict: bool = False, drops: Drops | None = None
) -> DataFrame:
    """(file_ord, pos, text) of all shards; blank, textless, malformed and unreadable lines are dropped, and counted in drops."""
    configure(spark)
    kinds = {p: detect_format(p).json for p in paths}
    if drops:
        drops._files = list(paths)
    out = None
    for is_json in (True, False):
        own = [p for p in paths if kinds[p] == is_json]
        if not own:
            continue
        found = lines(spark, own, drops=drops)
        # Positions in the part list become positions in the whole list.
        whole = F.create_map(*(F.lit(x) for i, p in enumerate(own) for x in (i, paths.index(p))))
        found = found.withColumn("file_ord", whole[F.col("file_ord")])
        if is_json:
            f = json_text_strict if strict else json_text
            found = found.select("file_ord", "pos", is_blank(F.col("value")).alias("blank"), f(F.col("value"), text_field).alias("r"))
            if drops:
                textless = F.col("r.text").isNull() & ~F.col("r.malformed") & ~F.col("blank")
                found = drops.watch(
                    found, blank=F.count_if("blank"), malformed=F.count_if("r.malformed"), textless=F.count_if(textless), files=F.collect_set("file_ord")
                )
            found = found.select("file_ord", "pos", F.col("r.text").alias("text")).filter("text IS NOT NULL")
        else:
            if drops:
                found = drops.watch(found, blank=F.count_if(is_blank(F.col("value"))), files=F.collect_set("file_ord"))
            found = found.filter(~is_blank(F.col("value"))).withColumnRenamed("value", "text")
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise FileNotFoundError("no files to read")
    return out
