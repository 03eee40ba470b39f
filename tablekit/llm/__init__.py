"""Operators of a training-data pipeline: dedup, decontamination, packing, filters.

Each module holds one operator with a general DataFrame interface; ``queries``
applies them to the test tables. Nothing outside this subpackage imports it.
"""
