"""Operators of a large-scale training-data pipeline, one module each.

Nothing outside this subpackage, ``corpus_pipeline.py`` and the entry module
imports it. Every operator takes and returns DataFrames; Python code inside
tasks is Arrow-batched, and only where the module's docstring says so.
"""
