"""Training-data operators: dedup, PII, packing, sharding, mixing, search, language ID, token output.

Nothing outside this subpackage (but for ``corpus_pipeline.py``) imports it.
"""
