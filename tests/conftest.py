import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_row():
    """A sound transaction as text; keyword arguments replace single cells."""
    base = {
        "Transaction_ID": "1",
        "Date": "2024-03-05 10:11:12",
        "Customer_Name": "ann lee",
        "Product": "['milk', 'bread']",
        "Total_Items": "3",
        "Total_Cost": "12.50",
        "Payment_Method": "cash",
        "City": "oslo",
        "Store_Type": "corner shop",
        "Discount_Applied": "True",
        "Customer_Category": "student",
        "Season": "spring",
        "Promotion": "bogo",
    }
    return lambda **cells: tuple({**base, **cells}.values())


@pytest.fixture(scope="session")
def bronze_of(spark, raw_row):
    from martloom import schemas
    from martloom.sources.readers import with_audit

    def build(*rows):
        return with_audit(spark.createDataFrame([raw_row(**r) for r in rows], schemas.RAW), "2024-03-06")

    return build
