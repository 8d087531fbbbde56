from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import streamweir
from streamweir.session import local_session, shared_root

cloudpickle.register_pickle_by_value(streamweir)


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    shared_root(session)
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
