"""Operators for building large text training sets, one module each.

Nothing outside this subpackage, ``corpus_pipeline.py`` and the guarded import
in ``__spark_entry__.py`` uses it.
"""
