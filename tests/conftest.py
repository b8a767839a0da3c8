import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from relload.session import local_session

    s = local_session(cpus="*", shuffle_partitions=4, app="relload-tests")
    s.conf.set("spark.sql.codegen.wholeStage", "false")  # the tables are tiny: compiling their plans costs more than running them
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="relload-test-")
