"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; the registered
queries are in :mod:`sentinela.llm.queries` and their SQL in
:mod:`sentinela.llm.oracle`. Nothing outside this package imports it, except
the guarded lookup in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
