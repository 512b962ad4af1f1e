import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_samples import DOCUMENTS, awkward  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
