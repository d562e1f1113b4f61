"""Next-token pairs, loss, guards and the small arithmetic of a decoder's input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shift_pairs(sequences: DataFrame, tokens: str = "tokens", keep: tuple[str, ...] = ()) -> DataFrame:
    """(cur, nxt) of every position that has a successor, with the columns of keep; sequences under two tokens have none."""
    nxt = F.expr(f"CASE WHEN size({tokens}) > 1 THEN transform(sequence(0, size({tokens}) - 2), i -> named_struct('cur', {tokens}[i], 'nxt', {tokens}[i + 1])) END")
    # A filter on the size would be pushed below an aggregation that makes the sequences.
    return sequences.select(F.explode_outer(nxt).alias("p"), *keep).filter("p IS NOT NULL").select("p.cur", "p.nxt", *keep)


def cross_entropy(logits: Column, target: Column) -> Column:
    """Of one position: log of the summed exponentials, less the target's logit; stable by its maximum."""
    z = F.transform(logits, lambda v: v.cast("double"))
    top = F.array_max(z)
    total = F.aggregate(z, F.lit(0.0), lambda a, v: a + F.exp(v - top))
    return F.log(total) + top - F.element_at(z, target.cast("int") + 1)


def next_token_loss(sequences: DataFrame, logits: str = "logits", tokens: str = "tokens") -> DataFrame:
    """One row, loss: the mean over all positions; the logit at t predicts the token at t + 1."""
    pairs = F.expr(f"transform(sequence(0, size({tokens}) - 2), i -> named_struct('z', {logits}[i], 't', {tokens}[i + 1]))")
    checked = sequences.select(
        F.when(F.size(tokens) >= 2, F.col(logits)).otherwise(F.raise_error(F.lit("a sequence needs two tokens"))).alias(logits), tokens
    )
    return checked.select(F.explode(pairs).alias("p")).agg(F.avg(cross_entropy(F.col("p.z"), F.col("p.t"))).alias("loss"))


def uniform_loss(vocab_size: Column) -> Column:
    return F.log(vocab_size.cast("double"))


def within_context(sequences: DataFrame, context: int, tokens: str = "tokens") -> DataFrame:
    return sequences.filter(F.size(tokens) <= context)


def causal_mask(spark: SparkSession, n: int) -> DataFrame:
    """(q, k): the positions k that position q may see; by rows, without a join."""
    return spark.range(n).select(F.col("id").alias("q"), F.explode(F.sequence(F.lit(0), "id")).alias("k"))


def causal_positions(lengths: DataFrame, n: str, keep: tuple[str, ...]) -> DataFrame:
    """The mask of many sequences: (keep, q, k), the positions k that position q of a sequence of n may see."""
    each = lengths.filter(F.col(n) > 0).select(*keep, F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("q"))
    return each.select(*keep, "q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q").cast("long"))).alias("k"))


def deterministic_token(place: Column, vocab_size: int) -> Column:
    return F.pmod(place * 7919, F.lit(vocab_size))


def deterministic_tokens(spark: SparkSession, batch: int, length: int, vocab_size: int) -> DataFrame:
    return spark.range(batch * length).select("id", deterministic_token(F.col("id"), vocab_size).alias("token"))


def embed(tokens: DataFrame, table: DataFrame) -> DataFrame:
    """tokens (seq, pos, id) with the vector of their id in table (id, vector)."""
    return tokens.join(table, "id")


def positions(vector: Column, pos: Column, width: int) -> Column:
    """A vector plus the sinusoidal code of its position."""
    code = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.when(i % 2 == 0, F.sin(pos / F.pow(F.lit(10000.0), (i - i % 2) / width))).otherwise(
            F.cos(pos / F.pow(F.lit(10000.0), (i - i % 2) / width))
        ),
    )
    return F.zip_with(vector, code, lambda a, b: a + b)
