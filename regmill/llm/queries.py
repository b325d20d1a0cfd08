"""All queries of this package, registered on import."""

from regmill.llm import (  # noqa: F401
    bit_planes,
    bpe,
    exact_dedup,
    fill_middle,
    filter_audit,
    language_id,
    mixing,
    ngram_join,
    ppm,
    quality_rules,
    secrets,
    substring_dedup,
    toxicity,
)
from regmill.llm.registry import ORACLES, QUERIES  # noqa: F401
