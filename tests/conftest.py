import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retentia.session import local_session

    session = local_session("tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def base(spark):
    from retentia.plans.churn_base import churn_base

    return churn_base(spark, "/root/testdata/sf0.01").persist()
