import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyloom.session import session

    at = tmp_path_factory.mktemp("shared")
    conf = {"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": f"file://{at}", "spark.sql.warehouse.dir": f"{at}/warehouse"}
    spark = session("tests", "local[8]", conf)
    yield spark
    spark.stop()
