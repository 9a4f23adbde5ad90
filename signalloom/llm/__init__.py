"""Operators of a training-data pipeline: counting, de-duplicating, searching, labelling, mixing and encoding documents.

Nothing outside this subpackage imports it.
"""
