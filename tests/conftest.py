import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from barloom.session import session

    spark = session(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__  # noqa: F401  ships the helpers to the workers by value

    yield spark
    spark.stop()
