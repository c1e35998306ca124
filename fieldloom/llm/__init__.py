"""Operators of a training-data pipeline, each built by one named method.

Nothing outside this folder imports it.  ``queries.py`` holds the registered
queries (``opN_<name>``); the operator modules keep their own general
interfaces.
"""
