import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labelqa.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="labelqa-tests", shuffle_partitions=4,
                  extra={"spark.ui.showConsoleProgress": "false",
                         "spark.local.dir": tempfile.mkdtemp(prefix="labelqa-test-local-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="labelqa-test-")


def col_values(df, name):
    return [r[name] for r in df.collect()]
