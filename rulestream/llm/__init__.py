"""Training-data operators: deduplication, packing, joins, scoring, extraction and search over text and vector tables.

Nothing else in the library imports this subpackage.  Operators take and return DataFrames; ``catalog`` derives
the registered queries from them.  ``corpus_pipeline`` (repository top) chains five of them.
"""
