"""Registration of queries and the table views (lenses) they read.

A lens is one SELECT, valid in Spark SQL and in DuckDB, that shapes the given tables
into an operator's input.  ``{name}`` refers to a table or to another lens.
"""

from __future__ import annotations

import string
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from abundix.session import apply_conf, cut_lineage

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LENSES: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(text) if name))


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings; a local one without a shared folder gets a temporary one."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        if context.master.startswith("local") and not context.master.startswith("local-cluster"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="abundix-"))
    return apply_conf(spark)


class Views:
    """The lenses of one scale folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._written: dict[str, DataFrame] = {}

    def write(self, *names: str) -> Views:
        """Work out the named lenses once; they, and lenses over them, are read from the written rows from now on."""
        for name in names:
            self._written[name] = cut_lineage(self[name])
        return self

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._written:
            return self._written[name]
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = LENSES[name]
        return self.spark.sql(text, **{n: self[n] for n in _names(text)})


def lens_sql(name: str) -> str:
    if name in TABLES:
        return name
    text = LENSES[name]
    return "(" + text.format(**{n: lens_sql(n) for n in _names(text)}) + ")"


def query(name: str, sql: str | None = None):
    """Register a query; ``{lens}`` in its SQL becomes the lens's subquery."""

    def register(function: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Views(prepared(spark), folder))
        if sql is not None:
            ORACLES[name] = sql.format(**{n: lens_sql(n) for n in _names(sql)})
        return function

    return register
