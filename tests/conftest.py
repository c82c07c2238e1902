import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sensorflow.session import get_spark

    s = get_spark(master="local[4]", app="sensorflow-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sensorflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """The 17 sensor lines with their line number as ``seq``."""
    with open(os.path.join(DATA, "sensor.txt")) as f:
        rows = [(i, line.rstrip("\n")) for i, line in enumerate(f)]
    return spark.createDataFrame(rows, "seq bigint, value string")


@pytest.fixture(scope="session")
def readings(spark, lines):
    from sensorflow.sources import parse_readings

    return parse_readings(lines, keep=["seq"]).cache()


@pytest.fixture(scope="session")
def hello(spark):
    from sensorflow.sources import read_lines

    return read_lines(spark, os.path.join(DATA, "hello.txt"))


def collect(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
