import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vigil.session import build_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[*]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": ckpt,
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    yield s


def rows(df, order=None):
    """Collected rows as plain tuples, sorted for order-free comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
