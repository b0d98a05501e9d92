import pytest

from millrace.session import get_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = get_session(
        "millrace-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(root / "checkpoints"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def as_rows():
    return rows
