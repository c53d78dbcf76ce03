"""Operators of a training-data pipeline; nothing else in the library imports them."""

from barloom.llm import (  # noqa: F401
    alignment,
    byte_bpe,
    embed_dedup,
    exact_dedup,
    html_text,
    licenses,
    lm_score,
    merkle,
    near_dedup,
    packing,
    quality,
    sharding,
    topk,
)
from barloom.llm.common import ORACLES, QUERIES  # noqa: F401
