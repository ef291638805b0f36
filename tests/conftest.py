import pytest

from basketlens.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cpus=8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)
