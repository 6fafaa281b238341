import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from abundix.session import apply_conf

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return apply_conf(session)


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of a list of tuples under a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def as_dict(df, key, value):
    keys = [key] if isinstance(key, str) else list(key)
    out = {}
    for row in df.collect():
        k = tuple(row[c] for c in keys)
        assert k not in out, f"two rows for {k}"
        out[k if len(keys) > 1 else k[0]] = row[value]
    return out
