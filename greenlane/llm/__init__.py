"""Training-data operators on Spark: scans, dedup, scoring, archives, filters.

Nothing else in the library imports this subpackage.
"""
