import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fleetreports.session import build_session

    scratch = tempfile.mkdtemp(prefix="fleetreports-tests-")
    s = build_session(
        "local[8]",
        app_name="fleetreports-tests",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    # Tests set their own checkpoint folder (the cluster names one in production).
    from fleetreports.session import checkpoint_root

    checkpoint_root(s, os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture
def scratch_dir():
    return tempfile.mkdtemp(prefix="fleetreports-run-")
