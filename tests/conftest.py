import pytest

from lakemart.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark, tmp_path):
    """An empty lake with database names of its own."""
    from lakemart.sources.lake import Lake

    made = Lake(spark, str(tmp_path / "lake"), f"t{abs(hash(str(tmp_path))) % 10**10}_")
    made.create()
    return made
