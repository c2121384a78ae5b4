import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from paddock.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    return local_session(4, 4, **{"spark.sql.warehouse.dir": warehouse})


@pytest.fixture(scope="session")
def frame(spark):
    """Small frame from rows and a DDL schema."""

    def build(rows, schema):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return build
