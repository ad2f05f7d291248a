"""Column-level expressions (all built-in, JVM-side, inside whole-stage codegen)."""

from ridgeline.functions.columns import (
    binarise,
    bucketise,
    geo_round,
    hash_unit,
    null_flag,
    safe_div,
    with_stats,
    text_length,
)

__all__ = ["binarise", "bucketise", "geo_round", "hash_unit", "null_flag", "safe_div", "with_stats", "text_length"]
