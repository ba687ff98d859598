"""Typed readers and writers for the operational tables and the marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .schemas import SCHEMAS, TABLES


class Tables:
    """Name -> lazily built DataFrame; each loader runs at most once per instance."""

    def __init__(self, loaders: dict[str, Callable[[], DataFrame]]):
        self._loaders = dict(loaders)
        self._built: dict[str, DataFrame] = {}
        self.sf_dir: str | None = None  # set when the tables derive from one test-data directory

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            if name not in self._loaders:
                raise AttributeError(f"unknown table {name!r}")
            self._built[name] = self._loaders[name]()
        return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def names(self) -> list[str]:
        return list(self._loaders)

    def with_table(self, name: str, df: DataFrame) -> "Tables":
        loaders = dict(self._loaders)
        loaders[name] = lambda: df
        return Tables(loaders)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project/cast a frame onto the declared schema of ``table`` (missing columns -> NULL)."""
    schema = SCHEMAS[table]
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Scan a landed table with its explicit schema (an empty table keeps its types)."""
    schema = SCHEMAS[table]
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "csv":
        # Header row, quoted fields may contain commas; timestamps are written without zone.
        return (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
                .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("mode", "PERMISSIVE").csv(path))
    raise ValueError(f"unsupported format {fmt}")


def landing_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> Tables:
    """One directory per table under ``root`` (the RAW layer)."""
    return Tables({t: (lambda t=t: read_table(spark, f"{root.rstrip('/')}/{t}", t, fmt)) for t in TABLES})


def extract_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
                 num_partitions: int, properties: dict[str, str] | None = None) -> DataFrame:
    """Full-table extract over a database connection, read by ``num_partitions`` tasks in parallel."""
    df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                         numPartitions=num_partitions, properties=properties or {})
    return conform(df, table)


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = (),
                    sort_within: Iterable[str] = (), append: bool = False, compression: str | None = None) -> int:
    """Full-refresh overwrite; returns the rows written, counted during the write (no second pass).

    With ``partition_by`` the rows are first range-partitioned on (partition columns, sort columns): a
    partition value gets few files, a large one several with disjoint key ranges. The sort starts with the
    partition columns, the order that a partitioned write needs, so it is kept inside the files.
    ``append`` adds the rows to those there: the further slices of a table that is written in several.
    """
    out, partition_by, sort_within = df, list(partition_by), list(sort_within)
    if partition_by:
        out = out.repartitionByRange(*partition_by, *sort_within)
    if sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    # counted above the range partitioning, whose sampling reads the rows once more
    obs = Observation("rows_written")
    w = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append" if append else "overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.format(fmt).save(path)
    return int(obs.get["rows"])


def load_tables(src: Tables, root: str, selected: Iterable[str] | None = None, upper_case: bool = False) -> dict[str, int]:
    """Copy all (or the selected) tables into ``root``; unknown names are rejected up front.

    Each table is one distributed write job (no buffering on the driver); the report is the
    row count per table observed while writing.
    """
    tables = list(selected) if selected else list(TABLES)
    unknown = sorted(set(tables) - set(TABLES))
    if unknown:
        raise ValueError(f"unknown table(s): {', '.join(unknown)}")
    report = {}
    for t in tables:
        df = conform(src[t], t)
        if upper_case:
            df = df.toDF(*[c.upper() for c in df.columns])
        report[t] = write_overwrite(df, f"{root.rstrip('/')}/{t}")
    return report


def export_csv(df: DataFrame, path: str, one_file_rows: int = 100_000) -> None:
    """CSV export with a header; one file up to ``one_file_rows`` rows, beyond that one per partition."""
    small = df.limit(one_file_rows + 1).count() <= one_file_rows
    writer = (df.coalesce(1) if small else df).write.mode("overwrite").option("header", True).option("escape", '"')
    # values keep their blanks: the writer's defaults would trim them
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
