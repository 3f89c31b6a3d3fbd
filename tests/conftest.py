import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from spanlog.session import build_session
    ckpt = tempfile.mkdtemp(prefix="spanlog-test-ckpt-")
    s = build_session(master="local[*]", app="spanlog-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


def hist_rows(spark, rows):
    """History DataFrame from (row_id, inode, type, dirname, filename, created, deleted) text rows."""
    from pyspark.sql import functions as F
    from spanlog.model import OPEN_TEXT, with_freq
    df = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4], r[5], r[6] or OPEN_TEXT) for r in rows],
        "row_id long, inode long, type string, dirname string, filename string, created string, deleted string")
    df = df.withColumn("created", F.to_timestamp("created")).withColumn("deleted", F.to_timestamp("deleted"))
    return with_freq(df)


def inv_rows(spark, rows):
    return spark.createDataFrame(rows, "inode long, type string, dirname string, filename string")
