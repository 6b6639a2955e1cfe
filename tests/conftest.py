from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from cartflow.settings import Settings, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def settings(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    return Settings(csv_dir=str(folder), root=str(tmp_path / "root"), buckets=3)
