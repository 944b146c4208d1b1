import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from relq.sources import schemas as S  # noqa: E402
from relq.sources.tables import from_rows  # noqa: E402

import housing_seed as H  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from relq.session import configure, ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="relq-warehouse-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="relq-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def housing(spark):
    """The six course tables as DataFrames, keyed by short role names."""
    return {
        "region": from_rows(spark, S.REGION_CODE, H.REGION_ROWS),
        "status": from_rows(spark, S.GUARANTEE_STATUS, H.STATUS_ROWS),
        "amount": from_rows(spark, S.GUARANTEE_AMOUNT, H.AMOUNT_ROWS),
        "payment": from_rows(spark, S.PENSION_PAYMENT, H.PAYMENT_ROWS),
        "age": from_rows(spark, S.SUBSCRIBER_AGE, H.AGE_ROWS),
        "price": from_rows(spark, S.MARKET_PRICE, H.PRICE_ROWS),
    }
