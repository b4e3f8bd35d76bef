import pytest

from tallyloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="12g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
