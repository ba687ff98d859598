"""greenlane: order-to-delivery analytics expressed as Spark DataFrame jobs.

Layers (mirroring a staging -> core -> KPI warehouse):

* ``greenlane.sources``   – typed readers/writers and the adapters that derive the
  eleven operational tables from the TPC-H-like test tables.
* ``greenlane.functions`` – Column helpers (guarded percentages, week start, enum
  normalisation, exact half-up rounding).
* ``greenlane.plans``     – staging conformers, core facts/dims, KPI marts and the
  stand-alone KPI queries, the ``build`` job.
* ``greenlane.operators`` – distributed ranking, data-quality checks, upserts,
  stock allocation and order-text extraction.
* ``greenlane.streaming`` – incremental refresh and streaming on-time counts.
"""

__version__ = "0.1.0"
