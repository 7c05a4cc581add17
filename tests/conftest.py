import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from hirelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # plans name whole paths, however long
    return local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.sql.maxMetadataStringLength": "2000"})


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
