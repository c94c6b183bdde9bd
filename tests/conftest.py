from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from spendstar.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    tables = tmp_path_factory.mktemp("spark-warehouse")
    s = local_session(cores="*", shuffle_partitions=8, app="spendstar-tests", driver_memory="4g",
                      extra_conf={"spark.sql.warehouse.dir": str(tables)})
    # Tests run locally: the shared folder is unset, so point it at pytest's temp dir.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
