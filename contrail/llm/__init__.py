"""Operators of a training-data pipeline.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.  Each
module holds one operator with its general interface; ``queries`` binds the
operators to the given tables.
"""
