"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage.  Each module is one
operator with a DataFrame interface; ``queries.py`` registers the thin
``opN_*`` queries on top of them.
"""
