from __future__ import annotations

import pytest

from tickloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
