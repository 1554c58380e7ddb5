"""Training-data operators: text clean-up, deduplication, tokenisation, packing.

Nothing outside this subpackage, ``corpus_pipeline.py`` and the guarded import
in ``__spark_entry__.py`` refers to it.
"""
