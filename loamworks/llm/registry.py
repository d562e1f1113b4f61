"""The queries of the corpus operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .alignment import op12_alignment
from .bpe import op3_bpe
from .fingerprints import op10_fingerprints
from .jaccard import op9_jaccard
from .langid import op2_langid
from .merkle import op11_merkle
from .mincut import op5_mincut
from .packing import op8_packing
from .quality import op6_quality
from .quotient import op13_exact_dedup
from .sharding import op4_sharding
from .substrings import op7_substrings
from .webp import op1_webp

_ALL = (
    op1_webp, op2_langid, op3_bpe, op4_sharding, op5_mincut, op6_quality, op7_substrings, op8_packing, op9_jaccard,
    op10_fingerprints, op11_merkle, op12_alignment, op13_exact_dedup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
