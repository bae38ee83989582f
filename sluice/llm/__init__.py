"""Training-data operators: dedup, search, PII, extraction, packing, tokens, quality, chat.

One module per operator, each with a general ``DataFrame -> DataFrame`` interface; the thin
registered queries and their SQL are in :mod:`sluice.llm.queries`. Nothing outside this
subpackage (and ``corpus_pipeline.py``, which counts as part of it) imports it.
"""
