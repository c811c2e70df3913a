import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from fieldlake.session import get_session
    scratch = tempfile.mkdtemp(prefix="fl-test-")
    s = get_session("local[4]", 4, app_name="fieldlake-tests",
                    extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                           "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fl-case-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
