"""Operators for preparing training data from a corpus of documents.

Each module holds one operator with its general interface; ``registry`` names
the queries that apply them to the given tables with production parameters.
Nothing outside this subpackage imports it.
"""
