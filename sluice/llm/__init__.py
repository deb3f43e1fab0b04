"""Operators of a training-data pipeline. Nothing else in the library imports
this subpackage; their registered queries and SQL are in ``queries.py``."""
