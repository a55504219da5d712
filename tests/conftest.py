import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from evidencepanel.plans.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Rows of text cells as a table with a ``_row`` column."""

    def build(rows, columns=None, types=None):
        columns = columns or list(rows[0])
        types = types or {}
        schema = ", ".join(["_row bigint", *[f"`{c}` {types.get(c, 'string')}" for c in columns]])
        data = [(i, *[r.get(c) for c in columns]) for i, r in enumerate(rows, start=1)]
        return spark.createDataFrame(data, schema)

    return build
