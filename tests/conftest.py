import pytest

from socialtext.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", shuffle_partitions=4,
                            **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    def read(name):
        return spark.read.parquet(f"{SF}/{name}.parquet")
    return read
