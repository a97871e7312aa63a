import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from portolan.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
              "spark.sql.shuffle.partitions": "4"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def plan_of(df, mode="formatted"):
    """The physical plan as text."""
    jvm = df.sparkSession._jvm
    explain = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(explain)
