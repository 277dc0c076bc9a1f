"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries (``queries.py``) only when the subpackage is there.
"""
