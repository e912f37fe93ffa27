from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from graphtables.session import session  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    own = session(
        "graphtables-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    own.sparkContext.setLogLevel("ERROR")
    yield own
    own.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not SF_DIR.exists():
        pytest.skip("driver tables are not here")
    return str(SF_DIR)


@pytest.fixture(scope="session")
def int_graph(spark):
    from tests.fixtures import int_graph

    return int_graph(spark)


@pytest.fixture(scope="session")
def string_graph(spark):
    from tests.fixtures import string_graph

    return string_graph(spark)
