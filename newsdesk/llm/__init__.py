"""Operators of a training-data pipeline. Nothing else in the library imports
this subpackage; its queries and SQL are in ``queries`` (see there)."""
