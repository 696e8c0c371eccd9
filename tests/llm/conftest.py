import os
import tempfile

import pytest

from ledgerwatch.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "llm-tests", **{"spark.sql.shuffle.partitions": "4"})
    if not session.sparkContext.getConf().get("spark.checkpoint.dir"):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
