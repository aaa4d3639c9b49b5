"""Training-data pipeline operators.

Nothing else in the library imports this package.  Each module holds one
operator with its own interface; :mod:`sylvan.llm.queries` derives the
registered ``opN_*`` queries from them.
"""
