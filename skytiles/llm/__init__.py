"""Operators of a training-data pipeline over the text tables.

Each module holds one operator with a general interface; ``queries``
registers the thin per-table queries. Nothing outside this subpackage
(but the pipeline module and the query registry) imports it.
"""
