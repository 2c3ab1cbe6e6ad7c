"""Operators of a training-data pipeline: toxicity, fingerprints, packing,
deduplication, mixing, extraction, URL filters and token counts.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when it is present.
"""
