import os

import pytest

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
