import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oncospan import Stage, session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                    spark__driver__memory="8g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("stage")))
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def stage(spark):
    return Stage(spark)
