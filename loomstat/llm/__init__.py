"""Operators of a training-data pipeline: cleaning, duplicates, mixing, packing, chat formatting.

Each module is one operator with a general interface; ``queries`` applies them to the given tables.
Nothing else in the library imports this subpackage.
"""
