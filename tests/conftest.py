import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers find the package too, wherever the tests are started
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

from lastmile.schemas import RAW  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from lastmile.session import LOCAL_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("lastmile-tests")
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "4").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def raw_rows(spark, rows):
    """Raw frame from partial dicts (missing columns are null)."""
    names = [f.name for f in RAW.fields]
    data = []
    for r in rows:
        unknown = set(r) - set(names)
        assert not unknown, unknown
        vals = []
        for n in names:
            v = r.get(n)
            if isinstance(v, str) and n.endswith("_at"):
                v = ts(v)
            if isinstance(v, (int, float, str)) and n in ("item_price", "delivery_cost", "item_discount"):
                v = Decimal(str(v))
            vals.append(v)
        data.append(tuple(vals))
    return spark.createDataFrame(data, RAW)


@pytest.fixture
def make_raw(spark):
    return lambda rows: raw_rows(spark, rows)
