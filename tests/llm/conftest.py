import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))

from casemill.session import local_session  # noqa: E402

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=8, app="casemill-tests")


@pytest.fixture
def docs(spark):
    """A frame of documents from (doc_id, text[, lang[, source]]) tuples."""

    def make(*rows):
        full = [(r + (None,) * 4)[:4] for r in rows]
        return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in full], DOC_SCHEMA)

    return make
