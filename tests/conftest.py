import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sedimenta.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {"spark.driver.memory": "8g"}
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = build_session("tests", cores=8, **settings)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(checkpoints))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def root(spark):
    from sedimenta.session import fresh_folder

    return fresh_folder(spark, "test")
