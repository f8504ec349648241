"""Operators for a large training-text pipeline, and the queries that apply them.

Nothing else in the library imports this subpackage.  General helpers (session
settings, the shared checkpoint folder) are imported from the library.
"""
