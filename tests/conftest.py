import pytest

from flowtide.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as tuples, in a fixed order."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)
