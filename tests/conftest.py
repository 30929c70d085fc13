from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cdmflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8,
                      checkpoint_dir=tempfile.mkdtemp(prefix="cdmflow-test-ckpt-", dir="/tmp"),
                      driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="cdmflow-test-", dir="/tmp")
