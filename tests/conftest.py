import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from monthly_facts import schema as S  # noqa: E402
from monthly_facts.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mf-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="mf-test-")


def bronze_rows(spark, rows):
    """Bronze DataFrame from dicts holding only the columns a test cares about;
    the other columns of interest are NULL."""
    cols = S.COLUMNS_OF_INTEREST + [S.SOURCE_COL]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    schema = ", ".join(f"{c} string" for c in cols)
    return spark.createDataFrame(data, schema)
