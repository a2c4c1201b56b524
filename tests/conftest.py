import pytest

from paylake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "paylake-tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(warehouse),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
