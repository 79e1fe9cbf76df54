"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it, apart from the guarded import in
``__spark_entry__`` and ``corpus_pipeline``.
"""
