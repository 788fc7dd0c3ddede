import pytest

from eventloom import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "eventloom-tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (or all)."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df.orderBy(*df.columns)).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
