"""Operators and a pipeline for large training-data corpora.

Nothing else in the package imports this subpackage; its queries are in
``tidyline.llm.queries``.
"""
