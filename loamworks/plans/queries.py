"""One query for each operator, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import bpe, codec, config, progress, sample, sequences
from ..operators.bpe import SPECIAL_TOKENS
from ..sources import files, scan
from ..staging import stage_path

MERGES = 64
#: Endings of the names made of documents.
ENDINGS = (
    ".jsonl", ".jsonl.gz", ".ndjson", ".NDJSON.GZ", ".txt", ".TXT.Gz", ".text", ".text.gz", ".parquet", ".json", ".rst", ".gz", ".txt.old",
    "jsonl", ".txt.zst",
)
ENV = "RUN_"
CONTEXT, SIZE, SECONDS = 1024, 16_000, 4.0
KINDS = {"view": "advanced", "click": "started", "purchase": "finished", "signup": "cached"}
BYTE_SIZES = (0, 700, 1023, 1024, 1331, 1536, 6 * 1024**2, 5 * 1024**3, 9 * 1024**4, 2500 * 1024**4)


def _table(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def _docs(s: SparkSession, d: str) -> DataFrame:
    return _table(s, d, "documents").select("doc_id", "text")


def _names(s: SparkSession, d: str) -> DataFrame:
    """A file name for each document."""
    ending = F.element_at(F.array(*map(F.lit, ENDINGS)), (F.col("doc_id") % len(ENDINGS) + 1).cast("int"))
    return _table(s, d, "documents").select("doc_id", F.concat("source", F.lit("-"), "doc_id", ending).alias("name"))


def shard_filter(s: SparkSession, d: str) -> DataFrame:
    return _names(s, d).select("name").filter(T.is_shard(F.col("name")))


def detect_format(s: SparkSession, d: str) -> DataFrame:
    return _names(s, d).select("name", T.is_json(F.col("name")).alias("json"), T.is_gzip(F.col("name")).alias("gzip"))


def cache_plan(s: SparkSession, d: str) -> DataFrame:
    """The names of labelled documents count as cached."""
    wanted = _names(s, d)
    cached = wanted.join(_table(s, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return files.cache_plan(wanted, cached)


def records(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d).filter(~T.is_blank(F.col("text")))


def text_lines(s: SparkSession, d: str) -> DataFrame:
    lines = _docs(s, d).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.filter(~T.is_blank(F.col("line"))).groupBy("doc_id", "line").agg(F.count(F.lit(1)).alias("n"))


def jsonl_text(s: SparkSession, d: str) -> DataFrame:
    scan.configure(s)
    line = F.to_json(F.struct("text", F.col("doc_id").alias("meta")))
    return _docs(s, d).select("doc_id", scan.json_text(line)["text"].alias("text")).filter("text IS NOT NULL")


def jsonl_nonstring(s: SparkSession, d: str) -> DataFrame:
    scan.configure(s)
    found = _table(s, d, "events").select("event_type", scan.json_text(F.col("props"), "k").alias("r"))
    return found.groupBy("event_type").agg(F.count("r.text").alias("kept"), F.count_if(F.col("r.text").isNull()).alias("skipped"))


def malformed_count(s: SparkSession, d: str) -> DataFrame:
    """Of the lines of each language: JSON, JSON cut short, another kind of field, another kind of root, blanks."""
    scan.configure(s)
    whole = F.to_json(F.struct("text"))
    cut = F.substring(whole, F.lit(1), F.length(whole) - 1)
    kind = F.col("doc_id") % 5
    line = (
        F.when(kind == 0, whole).when(kind == 1, cut).when(kind == 2, F.to_json(F.struct(F.col("n_chars").alias("text"))))
        .when(kind == 3, F.to_json(F.array("text"))).otherwise(F.lit(" \t"))
    )
    rows = _table(s, d, "documents").select("lang", scan.json_text(line).alias("r"))
    return rows.groupBy("lang").agg(F.count_if("r.malformed").alias("malformed"), F.count("r.text").alias("kept"))


def sample_prefix(s: SparkSession, d: str) -> DataFrame:
    return sample.prefix(_docs(s, d), ["doc_id"])


def _words(s: SparkSession, d: str) -> DataFrame:
    return bpe.word_counts(_docs(s, d))


def pretoken_counts(s: SparkSession, d: str) -> DataFrame:
    return _words(s, d)


def byte_histogram(s: SparkSession, d: str) -> DataFrame:
    listed = _words(s, d).select(F.explode(T.symbol_list(T.symbols(F.col("w")))).alias("byte"), "n")
    return listed.groupBy("byte").agg(F.sum("n").alias("n"))


def byte_alphabet(s: SparkSession, d: str) -> DataFrame:
    """The bytes of all documents with their letters."""
    found = byte_histogram(s, d).select(F.conv("byte", 16, 10).cast("int").alias("byte"), "n")
    return bpe.byte_alphabet(s).join(found, "byte")


def pair_counts(s: SparkSession, d: str) -> DataFrame:
    return bpe.pair_counts(_words(s, d).select(T.symbols(F.col("w")).alias("s"), "n"))


def merges_k(s: SparkSession, d: str) -> DataFrame:
    made, often = bpe.counted_merges(_docs(s, d), MERGES)
    rows = [(i, l.hex().upper(), r.hex().upper(), c) for i, ((l, r), c) in enumerate(zip(made, often, strict=True), 1)]
    return s.createDataFrame(rows, "step int, l string, r string, c bigint")


def _first_tokenizer(docs: DataFrame) -> bpe.Tokenizer:
    return bpe.Tokenizer(tuple(bpe.counted_merges(docs, MERGES)[0]))


def _with_tokens(s: SparkSession, d: str) -> DataFrame:
    """Documents with n_tokens after the first merges."""
    docs = _table(s, d, "documents").select("doc_id", "text", "lang")
    return codec.encode(docs, _first_tokenizer(docs)).withColumn("n_tokens", F.size("ids").cast("bigint")).drop("ids")


def encode_counts(s: SparkSession, d: str) -> DataFrame:
    return _with_tokens(s, d).filter("text <> ''").groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"))


def _ratio(chars: str, tokens: str):  # noqa: ANN202
    return F.when(F.col(tokens) == 0, 0.0).otherwise(F.round(F.col(chars) / F.col(tokens), 6))


def chars_per_token(s: SparkSession, d: str) -> DataFrame:
    both = _with_tokens(s, d).groupBy("lang")
    both = both.agg(F.sum(F.length("text")).alias("chars"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))
    ratio = _ratio("chars", "n_tokens")
    return both.select("lang", "chars", "n_tokens", ratio.alias("ratio"), ratio.between(3.0, 4.5).alias("in_band"))


def round_trip(s: SparkSession, d: str) -> DataFrame:
    """Through the ids of the first merges and back."""
    docs = _docs(s, d)
    tokenizer = _first_tokenizer(docs)
    back = codec.decode(codec.encode(docs, tokenizer), tokenizer)
    return back.select("doc_id", (F.col("decoded") == F.col("text")).alias("same"))


def report(s: SparkSession, d: str) -> DataFrame:
    docs = _docs(s, d)
    tokenizer = _first_tokenizer(docs)
    back = codec.decode(codec.encode(docs, tokenizer), tokenizer)
    total = back.agg(
        F.sum(F.length("text")).alias("chars"), F.sum(F.size("ids").cast("bigint")).alias("n_tokens"),
        F.bool_and(F.col("decoded") == F.col("text")).alias("round_trips"),
    )
    return total.select(
        F.lit(bpe.FLOOR + MERGES).cast("bigint").alias("vocab_size"), _ratio("chars", "n_tokens").alias("chars_per_token"), "round_trips"
    )


def specials(s: SparkSession, d: str) -> DataFrame:
    """The reserved tokens, and how many texts of documents and conversations hold their letters."""
    texts = _docs(s, d).select("text").union(_table(s, d, "conversations").select("text"))
    held = texts.agg(*(F.count_if(F.contains("text", F.lit(t))).alias(f"n{i}") for i, t in enumerate(SPECIAL_TOKENS)))
    each = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(t).alias("token"), F.col(f"n{i}").alias("n")) for i, t in enumerate(SPECIAL_TOKENS)))
    return held.select(F.inline(each))


def special_atomic(s: SparkSession, d: str) -> DataFrame:
    """Every document with a reserved token behind it, as bytes: the token adds one id, and that is its own."""
    k = F.pmod("doc_id", F.lit(len(SPECIAL_TOKENS))).cast("int")
    docs = _docs(s, d).withColumn("k", k).withColumn("text", F.concat("text", F.element_at(F.array(*map(F.lit, SPECIAL_TOKENS)), k + 1)))
    made = codec.encode(docs, bpe.Tokenizer(()))
    return made.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), (F.element_at("ids", -1) == F.col("k")).alias("last"))


def vocab(s: SparkSession, d: str) -> DataFrame:
    made = bpe.counted_merges(_docs(s, d), MERGES)[0]
    rows = [(i, t.encode().hex().upper(), "special") for i, t in enumerate(SPECIAL_TOKENS)]
    rows += [(5 + b, f"{b:02X}", "byte") for b in range(256)]
    rows += [(bpe.FLOOR + i, (l + r).hex().upper(), "merge") for i, (l, r) in enumerate(made)]
    return s.createDataFrame(rows, "id int, token string, kind string")


def shift_pairs(s: SparkSession, d: str) -> DataFrame:
    """Over distinct pieces: a word and the first byte of the next one, so each pair of neighbours is in one piece."""
    texts = _docs(s, d).select(F.transform(T.pretokens(F.col("text")), lambda w: F.hex(F.encode(w, "UTF-8"))).alias("words"))
    piece = F.transform("words", lambda w, i: F.concat(w, F.coalesce(F.substring(F.get("words", i + 1), 1, 2), F.lit(""))))
    pieces = texts.select(F.explode(piece).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    tokens = pieces.select(T.symbol_list(F.regexp_replace("x", "(..)", "<$1>")).alias("tokens"), "n")
    return sequences.shift_pairs(tokens, keep=("n",)).groupBy("cur", "nxt").agg(F.sum("n").alias("n"))


def cross_entropy(s: SparkSession, d: str) -> DataFrame:
    rows = _table(s, d, "embeddings")
    return rows.select("vec_id", F.round(sequences.cross_entropy(F.col("embedding"), F.col("label")), 6).alias("loss"))


def uniform_loss(s: SparkSession, d: str) -> DataFrame:
    """Of a guess among the distinct texts of each language."""
    sizes = _table(s, d, "documents").groupBy("lang").agg(F.count_distinct("text").alias("vocab_size"))
    return sizes.select("lang", "vocab_size", F.round(sequences.uniform_loss(F.col("vocab_size")), 9).alias("loss"))


def context_guard(s: SparkSession, d: str) -> DataFrame:
    return encode_counts(s, d).filter(F.col("n_tokens") <= CONTEXT)


def causal_mask(s: SparkSession, d: str) -> DataFrame:
    """Which turns of its conversation each turn may see."""
    lengths = _table(s, d, "conversations").groupBy("conv_id").agg((F.max("turn") + 1).cast("bigint").alias("n"))
    return sequences.causal_positions(lengths, "n", ("conv_id",))


def det_tokens(s: SparkSession, d: str) -> DataFrame:
    return _table(s, d, "documents").select("doc_id", sequences.deterministic_token(F.col("doc_id"), SIZE).alias("token"))


def layered_config(s: SparkSession, d: str) -> DataFrame:
    """The context length of a run for each order: base, file, environment, flag, and a tokenizer above them."""
    key = F.col("o_orderkey")
    layers = (
        F.when(F.col("o_orderstatus") == "F", key % 4096), F.when(F.col("o_orderpriority").startswith("1"), key % 512),
        F.when(key % 7 == 0, key % 64), F.when(key % 11 == 0, F.lit(300)),
    )
    return _table(s, d, "orders").select("o_orderkey", config.resolved(F.col("o_custkey"), *layers).cast("bigint").alias("resolved"))


def env_parse(s: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_id") % 3
    key = F.concat(F.when(F.col("event_id") % 4 == 0, F.lit("OTHER_")).otherwise(F.lit(ENV)), F.upper("event_type"))
    value = F.when(kind == 0, F.col("props")).when(kind == 1, F.col("user_id").cast("string")).otherwise(F.col("event_type"))
    rows = _table(s, d, "events").select("event_id", config.env_setting(key, value, ENV).alias("e")).filter("e IS NOT NULL")
    return rows.select("event_id", "e.key", "e.value")


def model_sizes(s: SparkSession, d: str) -> DataFrame:
    """A model for each part."""
    n = F.col("p_size").cast("bigint")
    width, heads = n * 12, F.col("p_partkey") % 13
    parameters = config.approx_parameters(n * 1000, F.lit(CONTEXT).cast("bigint"), width, n * 48, n)
    head = F.coalesce(config.head_dim(width, heads), F.lit(0))  # 0: the heads don't divide the width
    return _table(s, d, "part").select("p_partkey", head.alias("head_dim"), parameters.cast("bigint").alias("parameters"))


def run_json(s: SparkSession, d: str) -> DataFrame:
    """A run for each order, as JSON and back."""
    key = F.col("o_orderkey")
    own = {
        "vocab_size": key, "context_length": F.lit(CONTEXT), "d_model": F.col("o_custkey"), "d_ff": F.col("o_custkey") * 4, "num_layers": key % 48,
        "num_heads": key % 16, "norm_first": F.col("o_orderstatus") == "F", "learning_rate": F.col("o_totalprice"),
    }
    back = _table(s, d, "orders").select("o_orderkey", config.run_of_json(config.run_json(own)).alias("r"))
    return back.select("o_orderkey", "r.model.*", "r.training.learning_rate", "r.training.max_steps")


def progress_fold(s: SparkSession, d: str) -> DataFrame:
    """The events of each day as those of a download."""
    kind = F.coalesce(*(F.when(F.col("event_type") == k, F.lit(v)) for k, v in KINDS.items()), F.lit("other"))
    events = _table(s, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").alias("seq"), kind.alias("kind"),
        F.when(kind.isin("started", "cached"), F.col("user_id")).alias("total"), F.round(F.col("value") * 100).cast("bigint").alias("bytes"),
    )
    folded = progress.fold(events, "day")
    return folded.select("*", (F.col("run_bytes") / F.lit(SECONDS)).alias("rate"))


def format_bytes(s: SparkSession, d: str) -> DataFrame:
    own = s.createDataFrame([(b,) for b in BYTE_SIZES], "bytes bigint")
    return own.union(_table(s, d, "documents").select(F.col("n_chars").alias("bytes")).distinct()).distinct().select("bytes", T.format_bytes(F.col("bytes")).alias("shown"))


def shard_records(s: SparkSession, d: str) -> DataFrame:
    """Documents written as shards of three formats, and the records that a scan of the shards gives."""
    docs, base, paths = _docs(s, d), stage_path(s), []
    for k, ending in enumerate((".jsonl", ".jsonl.gz", ".txt.gz")):
        paths += files.write_shards(docs.filter(F.col("doc_id") % 3 == k), f"{base}/{k}", ending)
    json = F.array(*(F.lit(files.detect_format(p).json) for p in paths))
    found = scan.records(s, paths).select(F.element_at(json, F.col("file_ord") + 1).alias("json"), "text")
    return found.groupBy("json", "text").agg(F.count(F.lit(1)).alias("n"))


_ALL: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    shard_filter, detect_format, cache_plan, records, text_lines, jsonl_text, jsonl_nonstring, malformed_count, sample_prefix,
    pretoken_counts, byte_histogram, byte_alphabet, pair_counts, merges_k, encode_counts, chars_per_token, round_trip, report,
    specials, special_atomic, vocab, shift_pairs, cross_entropy, uniform_loss, context_guard, causal_mask, det_tokens,
    layered_config, env_parse, model_sizes, run_json, progress_fold, format_bytes, shard_records,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f"q{i:02}_{f.__name__}": f for i, f in enumerate(_ALL, 1)}
