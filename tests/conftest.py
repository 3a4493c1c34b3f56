from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from emporium.session import build_session
    warehouse = tempfile.mkdtemp(prefix="emporium-test-warehouse-")
    s = build_session("local[4]", 4, app_name="emporium-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    # tests own their checkpoint folder (a cluster would name a shared one)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="emporium-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="emporium-test-")


def rows(df, order=None):
    """Collected rows as plain tuples, sorted for order-insensitive checks."""
    out = [tuple(r) for r in df.collect()]
    return out if order == "keep" else sorted(out, key=repr)
