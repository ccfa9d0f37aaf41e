import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rankfold.session import get_session

    return get_session(master="local[*]", shuffle_partitions=8, app="rankfold-tests")


@pytest.fixture(scope="session")
def tiny_docs(spark):
    return spark.createDataFrame(
        [(1, "wing flow flow"), (2, "flow heat"), (3, "heat heat shock wave")], "doc_id long, text string")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
