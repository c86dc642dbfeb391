"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``labels``.

One module per operator, ``queries`` for the registered queries and their SQL.
Nothing outside this package imports it except the guarded entry in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
