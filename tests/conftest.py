import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "weekloom-tests", {
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staging")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.driver.memory": "4g",
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame whose date columns are given as text."""
    def build(rows, schema, dates=("data",)):
        text = ", ".join(
            f"{p.split()[0]} string" if p.split()[0] in dates else p for p in schema.split(", "))
        df = spark.createDataFrame(rows, text)
        for c in dates:
            if c in df.columns:
                df = df.withColumn(c, df[c].cast("date"))
        return df
    return build


def as_dict(df, *keys):
    """Rows by key, with dates as text."""
    def plain(v):
        return v.isoformat() if hasattr(v, "isoformat") else v
    out = {}
    for r in df.collect():
        key = tuple(plain(r[k]) for k in keys)
        out[key[0] if len(key) == 1 else key] = {c: plain(r[c]) for c in df.columns if c not in keys}
    return out
