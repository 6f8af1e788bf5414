"""Operators that prepare training data: dedup, decontamination, quality, packing, sharding and token counts.

Nothing outside this folder and `corpus_pipeline.py` imports it.
"""
