import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__  # noqa: E402,F401  (ships task code to the workers)
from tablekit.sinks import TableSink  # noqa: E402
from verification.local import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture
def sink(spark, tmp_path, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return TableSink(spark, f"db_{name}", str(tmp_path / "tables"))


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
