"""Document fingerprints by randomised edit embedding (operator 10).

A text is read by a shared random walk: at step j the character under the
head is written down, and a bit that depends on j and the character alone
decides whether the head moves on. Two texts of small edit distance fall back
into step soon after each edit, so what they write differs in few places: edit
distance becomes Hamming distance. The walk starts anew every ``BLOCK``
characters, so all blocks of a batch walk in lockstep as NumPy lanes.

A fingerprint is the text's length and a sample of the steps, each with eight
bits of a hash of the last eight characters written. Sampled steps are nested:
a longer text keeps a subset of the steps of a shorter one, hence any two
fingerprints can be compared. It holds 128 to 256 samples for all but the
shortest texts, and one of each block for texts of over about a million
characters: a last block that ends before the sampled steps has a sample at
the step of the highest level that it reaches. ``near_pairs`` bands bit samples
of fingerprints, and verifies all pairs of distinct fingerprints that share a band.

Cases: a null text is empty; an empty text has an empty sample, likeness 1 to
an empty one and 0 to others; rows of one id are ordered by their text, null
ids come last; a table of one row has itself as its next; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_pass, staged, table, text_of

BLOCK = 4096
SAMPLES = 256
#: Characters of a text that are walked at a time.
SLICE = 256 * BLOCK
SEED = 20
#: Leaders of a band that one cell of ``near_pairs`` takes from each side, about.
CELL = 1024
_END = 255


def steps_for(n: int) -> int:
    """Steps that read n characters, nearly surely: each moves on with probability one half."""
    return 2 * n + 4 * math.isqrt(n) + 8


STEPS = steps_for(BLOCK)
_LEVELS = STEPS.bit_length() - 1


class _Walk:
    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        self.moves = rng.integers(0, 2, (STEPS, 256), np.uint8)
        self.moves[:, _END] = 0  # the head stays at the end of the text
        self.hash = rng.integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)
        rank = rng.permutation(STEPS)
        # Level v holds every 2**v-th step, at least one.
        self.level = np.zeros(STEPS, np.int8)
        for v in range(1, _LEVELS + 1):
            self.level[rank < max(1, STEPS >> v)] = v
        #: The highest level among the first steps, so many.
        self.highest = np.maximum.accumulate(self.level)
        self.at_level = [np.flatnonzero(self.level >= v) for v in range(_LEVELS + 1)]


_WALK: list[_Walk] = []


def walk() -> _Walk:
    if not _WALK:
        _WALK.append(_Walk())
    return _WALK[0]


def _blocks(n: int) -> list[int]:
    """The lengths of the blocks of n characters."""
    return [BLOCK] * (n // BLOCK) + [n % BLOCK] * (n % BLOCK > 0)


def level_of(n: int) -> int:
    total = (n // BLOCK) * STEPS + (steps_for(n % BLOCK) if n % BLOCK else 0)
    return min(max(0, math.ceil(math.log2(total / SAMPLES))), _LEVELS) if total else 0


def block_level(m: int, level: int) -> int:
    """The level at which a block of m characters of a text of that level is sampled: no higher than one that it reaches.

    About two steps a character read it; what is written after that may be the end alone.
    """
    return min(level, int(walk().highest[2 * m - 1]))


def places(n: int, level: int) -> np.ndarray:
    """The sampled steps of a text of n characters, as block * STEPS + step."""
    out = []
    for b, m in enumerate(_blocks(n)):
        own = walk().at_level[block_level(m, level)]
        out.append(own[: np.searchsorted(own, steps_for(m))] + b * STEPS)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _classes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    far = (c * np.uint32(0x9E3779B1)) >> np.uint32(25)
    return np.where(c < 128, c, 128 + far % 127).astype(np.uint8)


def embed(texts: list[str]) -> list[np.ndarray]:
    """The samples of every text at its own level; a very long text is walked in slices of whole blocks."""
    levels = [level_of(len(t)) for t in texts]
    out = _walked(["" if len(t) > SLICE else t for t in texts], levels)
    for d, t in enumerate(texts):
        if len(t) > SLICE:
            out[d] = np.concatenate([_walked([t[a : a + SLICE]], [levels[d]])[0] for a in range(0, len(t), SLICE)])
    return out


def _walked(texts: list[str], levels_: list[int]) -> list[np.ndarray]:
    """The samples of every text at the level given for it, walked in lockstep."""
    w = walk()
    parts, start, steps, level, doc = [], [], [], [], []
    at, end = 0, np.array([_END], np.uint8)
    for d, text in enumerate(texts):
        c = _classes(text)
        for b, m in enumerate(_blocks(len(text))):
            parts += [c[b * BLOCK : b * BLOCK + m], end]
            start.append(at)
            steps.append(steps_for(m))
            level.append(block_level(m, levels_[d]))
            doc.append(d)
            at += m + 1
    out = [np.zeros(0, np.uint8)] * len(texts)
    if not parts:
        return out
    buf = np.concatenate(parts)
    steps_, level_ = np.array(steps), np.array(level)
    order = np.argsort(-steps_, kind="stable")
    pos = np.array(start)[order]
    ends = steps_[order]
    lowest = np.minimum.accumulate(level_[order])
    h = np.zeros(len(pos), np.uint32)
    taken: list[int] = []
    held: list[np.ndarray] = []
    n = len(pos)
    four = np.uint32(4)
    active = np.searchsorted(-ends, -np.arange(int(ends[0])), side="left").tolist()
    levels, mixed = w.level.tolist(), w.hash
    for j, a in enumerate(active):
        if a < n:
            pos, h, n = pos[:a], h[:a], a
        c = buf.take(pos)
        np.left_shift(h, four, out=h)
        np.bitwise_xor(h, mixed.take(c), out=h)
        if levels[j] >= lowest[a - 1]:
            taken.append(j)
            held.append((h >> np.uint32(24)).astype(np.uint8))
        pos = pos + w.moves[j].take(c)
    grid = np.zeros((len(taken), len(order)), np.uint8)
    for r, x in enumerate(held):
        grid[r, : len(x)] = x
    grid = np.ascontiguousarray(grid.T)
    taken_ = np.array(taken)
    taken_level = w.level[taken_]
    lane = np.empty(len(order), np.int64)
    lane[order] = np.arange(len(order))
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for k, d in enumerate(doc):
        upto = np.searchsorted(taken_, steps[k])
        found[d].append(grid[lane[k], :upto][taken_level[:upto] >= level[k]])
    return [np.concatenate(x) if x else out[d] for d, x in enumerate(found)]


def likeness(n1: int, s1: np.ndarray, n2: int, s2: np.ndarray) -> float:
    """The share of common sampled steps that agree, of the larger sample."""
    if not n1 or not n2:
        return float(n1 == n2)
    if n1 == n2:
        return float(np.count_nonzero(s1 == s2) / len(s1))
    a, b = level_of(n1), level_of(n2)
    top = max(a, b)
    p1, p2 = places(n1, top), places(n2, top)
    s1 = s1 if a == top else s1[np.isin(places(n1, a), p1, assume_unique=True)]
    s2 = s2 if b == top else s2[np.isin(places(n2, b), p2, assume_unique=True)]
    _, i, j = np.intersect1d(p1, p2, assume_unique=True, return_indices=True)
    return float(np.count_nonzero(s1[i] == s2[j]) / max(len(p1), len(p2), 1))


def as_text(n: int, samples: np.ndarray) -> str:
    return f"{n:x}:{samples.tobytes().hex()}"


def parsed(fingerprint: str) -> tuple[int, np.ndarray]:
    n, _, s = fingerprint.partition(":")
    return int(n, 16), np.frombuffer(bytes.fromhex(s), np.uint8)


def edited(text: str, after: str) -> str:
    """The last half replaced by as much of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["doc_id", *(x.split()[0] for x in FIELDS.split(","))]
_KINDS = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _rows(texts: list[str]) -> list[tuple]:
    """The columns of FIELDS for all texts but the last, each with the one after it."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    samples = embed(texts + changed)
    out = []
    for i, e in enumerate(changed):
        n, m = len(texts[i]), len(texts[i + 1])
        own, other, new = samples[i], samples[i + 1], samples[len(texts) + i]
        out.append((
            n, hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), as_text(n, own), as_text(len(e), new),
            likeness(n, own, len(e), new), likeness(n, own, m, other),
        ))
    return out


def _arrays(rows: list[tuple]) -> list[pa.Array]:
    cols = zip(*rows, strict=True) if rows else [()] * len(_KINDS)
    return [pa.array(list(c), k) for c, k in zip(cols, _KINDS, strict=True)]


def _cuts(texts: list[str], limit: int = 1_500_000) -> Iterator[tuple[int, int]]:
    """Runs of the rows before the last; each also needs the row after it."""
    a, size = 0, 0
    for i in range(len(texts) - 1):
        size += len(texts[i])
        if size >= limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts) - 1:
        yield a, len(texts) - 1


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, the fingerprints of a text and of its edited text, and likenesses."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def out(ids: pa.Array, found: list[tuple], rim: str | None, text: str | None) -> pa.RecordBatch:
            n = len(ids)
            arrays = [ids, *(_arrays(found) if found else [pa.nulls(n, k) for k in _KINDS])]
            arrays += [pa.array([part] * n, pa.int32()), pa.array([rim] * n, pa.string()), pa.array([text] * n, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, [*_NAMES, "part", "rim", "text"])

        last: tuple[pa.Array, str] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            if last is None:
                yield out(ids.slice(0, 1), [], "head", texts[0])
            else:
                ids, texts = pa.concat_arrays([last[0], ids]), [last[1], *texts]
            for a, b in _cuts(texts):
                yield out(ids.slice(a, b - a), _rows(texts[a : b + 1]), None, None)
            last = ids.slice(len(texts) - 1, 1), texts[-1]
        if last is not None:
            yield out(last[0], [], "tail", last[1])

    made = staged(arrow_pass(ordered, run, f"doc_id {kind}, {FIELDS}, part int, rim string, text string"))
    inner = made.filter("rim IS NULL").select(*_NAMES)
    # Two rows for each range partition: the last text of one is followed by the first of the next.
    rims = made.filter("rim IS NOT NULL").select("doc_id", "part", "rim", "text")
    heads = rims.filter("rim = 'head'")
    ring = Window.orderBy("part")
    after = heads.select(
        F.lag("part", 1).over(ring).alias("before"), F.max("part").over(Window.partitionBy()).alias("end"), F.col("text").alias("after")
    )
    after = after.select(F.coalesce("before", "end").alias("part"), "after")
    open_ = rims.filter("rim = 'tail'").join(after, "part").select("doc_id", "text", "after")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_rows([a, b])[0] for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_arrays(found)], _NAMES)

    return inner.unionByName(arrow_pass(open_, close, f"doc_id {kind}, {FIELDS}"))


def _drawn(p: np.ndarray, level: int, bands: int, per: int) -> np.ndarray:
    """For each band, where in p its samples lie: the places that a seeded hash of level and band ranks first.

    The places of a shorter text of the level are among those of a longer one, so a place that is drawn for
    the longer text is drawn for both if both have it.
    """
    rng = np.random.default_rng((SEED, level))
    seeds = rng.integers(0, 1 << 63, (bands, 1), np.uint64)
    h = (p.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ seeds
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return np.argsort(h ^ (h >> np.uint64(31)), axis=1, kind="stable")[:, :per]


def near_pairs(marks: DataFrame, least: float = 0.75, bands: int = 12, bits: int = 24) -> DataFrame:
    """(a, b, likeness) of near duplicates among marks (doc_id, fingerprint), by bit-sampled bands.

    A band is `bits` bits of the samples at a few steps, drawn from the whole text, of the top level shared by
    texts of one length class or the next. Rows of equal fingerprints are one group, led by the least id: each
    row meets its leader, whose other pairs are its own too. Leaders that share a band are all compared, each
    pair once, in cells of about `CELL` leaders a side; every pair is verified by its likeness.

    Rows that share id and fingerprint are one; a null id is greater than all others.
    """
    per = bits // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for f in batch.column(1).to_pylist():
                n, s = parsed(f)
                own, keys = level_of(n), set()
                for level in range(own, min(own + 1, _LEVELS) + 1):
                    p = places(n, level)
                    t = s if level == own else s[np.isin(places(n, own), p, assume_unique=True)]
                    for k, pick in enumerate(_drawn(p, level, bands, per)):
                        key = f"{level}:{k}:{p[pick].tolist()}:{t[pick].tobytes().hex()}"
                        keys.add(int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little", signed=True))
                found.append(sorted(keys))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int64()))], ["doc_id", "fingerprint", "bands"])

    kind = dict(marks.dtypes)["doc_id"]
    rows = marks.select("doc_id", "fingerprint").distinct()
    leads = staged(arrow_pass(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "fingerprint"), run, f"doc_id {kind}, fingerprint string, bands array<long>"))
    copies = rows.join(leads.select(F.col("doc_id").alias("a"), "fingerprint"), "fingerprint").filter(~F.col("a").eqNullSafe(F.col("doc_id")))
    copies = copies.select("a", F.col("doc_id").alias("b"), F.lit(1.0).alias("likeness"))

    # A band of k leaders is cut into g parts: cell (i, j) holds the leaders of part i and of part j.
    banded = leads.withColumn("band", F.explode("bands"))
    parts = banded.groupBy("band").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("band", F.ceil(F.col("k") / CELL).cast("int").alias("g"))
    parted = banded.join(parts, "band").withColumn("i", F.pmod(F.xxhash64("fingerprint"), "g").cast("int"))
    cells = parted.withColumn("j", F.explode(F.expr("sequence(0, g - 1)")))
    cells = cells.select("doc_id", "fingerprint", "bands", "band", "i", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    x, y = cells.alias("x"), cells.alias("y")
    before = F.coalesce(F.col("x.doc_id") < F.col("y.doc_id"), F.col("x.doc_id").isNotNull() & F.col("y.doc_id").isNull())
    before = before | (F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.fingerprint") < F.col("y.fingerprint")))
    # Pairs of one part meet in its own cell alone, and pairs of several bands in the least band alone.
    here = (F.col("x.i") != F.col("y.i")) | (F.col("x.lo") == F.col("x.hi"))
    first = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.band")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("band", "lo", "hi")]
    pairs = x.join(y, [*same, before & here & first])
    pairs = pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), F.col("x.fingerprint").alias("fa"), F.col("y.fingerprint").alias("fb"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [likeness(*parsed(x), *parsed(y)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.float64())], ["a", "b", "likeness"])

    return arrow_pass(pairs, verify, f"a {kind}, b {kind}, likeness double").unionByName(copies).filter(F.col("likeness") >= least)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
