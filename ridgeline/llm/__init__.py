"""Operators of a training-data pipeline over document and embedding tables.

Each module holds one operator with a general interface; :mod:`ridgeline.llm.queries` binds
them to the test tables.  Nothing else in the library imports this subpackage.
"""
