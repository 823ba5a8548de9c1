import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from forumlake.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        shuffle_partitions=4,
        **{"spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": str(base / "shared")},
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return collect
