from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from playlake.session import build_session

    s = build_session(
        app_name="playlake-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra_conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()
