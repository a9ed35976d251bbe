"""Operators for preparing training corpora at scale.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface plus the thin ``opN_*`` query that applies it
to a whole table; :mod:`graphloom.llm.registry` lists the queries.
"""
