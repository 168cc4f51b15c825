import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = lambda name: tmp_path_factory.mktemp(name).as_uri()
    session = local_session(4, "4g", {"spark.sql.warehouse.dir": folder("tables"), "spark.checkpoint.dir": folder("shared")})
    yield session
    session.stop()
