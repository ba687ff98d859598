from .io import Tables, conform, landing_tables, load_tables, read_table, write_overwrite
from .schemas import KEYS, SCHEMAS, TABLES

__all__ = ["Tables", "conform", "landing_tables", "load_tables", "read_table", "write_overwrite",
           "KEYS", "SCHEMAS", "TABLES", "tpch_tables"]


def tpch_tables(spark, sf_dir):
    from .adapters import tpch_tables as _t
    return _t(spark, sf_dir)
