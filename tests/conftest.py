import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from adloom.session import local_session  # noqa: E402
from adloom.sources import staging  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4)
    staging.use_folder(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)
