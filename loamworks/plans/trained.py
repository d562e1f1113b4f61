"""Queries of the trained tokenizer over all documents; training of a whole vocabulary is no SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bpe, codec, model, weights
from ..operators.config import ModelConfig

#: Merges of the tokenizer, and context of the model, of the loss over documents.
LOSS_MERGES, LOSS_CONTEXT = 500, 128


def _docs(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def trained_encode(s: SparkSession, d: str, vocab_size: int = bpe.VOCAB_SIZE) -> DataFrame:
    """doc_id, n_chars and the ids of every document by a tokenizer that is trained on all of them."""
    docs = _docs(s, d)
    made = codec.encode(docs, bpe.train(docs, vocab_size))
    return made.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "ids")


def trained_decode(s: SparkSession, d: str, vocab_size: int = bpe.VOCAB_SIZE) -> DataFrame:
    """doc_id, n_tokens, and whether the ids of the document decode to its text."""
    docs = _docs(s, d)
    tokenizer = bpe.train(docs, vocab_size)
    made = codec.decode(codec.encode(docs, tokenizer), tokenizer)
    same = F.col("decoded") == F.col("text")
    return made.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("same"))


def trained_report(s: SparkSession, d: str, vocab_size: int = bpe.VOCAB_SIZE) -> DataFrame:
    """One row: the size of the vocabulary, characters per token, whether they lie in the band, the round trip."""
    docs = _docs(s, d)
    tokenizer = bpe.train(docs, vocab_size)
    made = codec.decode(codec.encode(docs, tokenizer), tokenizer)
    total = made.agg(
        F.sum(F.length("text")).alias("chars"), F.sum(F.size("ids")).alias("n"), F.bool_and(F.col("decoded") == F.col("text")).alias("round_trips")
    )
    ratio = F.when(F.col("n") > 0, F.col("chars") / F.col("n")).otherwise(0.0)
    return total.select(
        F.lit(tokenizer.vocab_size()).cast("bigint").alias("vocab_size"), ratio.alias("chars_per_token"),
        ratio.between(codec.LOW, codec.HIGH).alias("in_band"), "round_trips",
    )


def loss_model(vocab_size: int) -> ModelConfig:
    return ModelConfig(vocab_size, LOSS_CONTEXT, 32, 64, 1, 2, True)


def decoder_loss(s: SparkSession, d: str) -> DataFrame:
    """doc_id, n_predicted, and the mean next-token loss of every document by an untrained decoder (null without a pair).

    Documents become ids, these windows of the context, and these losses; the weights are a file that is sent to
    each machine once.
    """
    docs = _docs(s, d)
    tokenizer = bpe.Tokenizer(tuple(bpe.counted_merges(docs, LOSS_MERGES)[0]))
    config = loss_model(tokenizer.vocab_size())
    # Ids of documents may repeat: a name of the row keeps their windows apart.
    named = docs.withColumn("row", F.monotonically_increasing_id())
    cut = model.windows(codec.encode(named, tokenizer), LOSS_CONTEXT, keep=("row",))
    found = model.next_token_losses(cut, config, weights.staged_initial(s, config), keep=("row",))
    sums = found.groupBy("row").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return named.select("doc_id", "row").join(sums, "row", "left").select("doc_id", n.alias("n_predicted"), (F.col("loss") / F.col("n")).alias("loss"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (trained_encode, trained_decode, trained_report, decoder_loss)}
