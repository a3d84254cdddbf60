import hashlib

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, removed string, digest string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with clashing extra columns from (doc_id, text) rows."""

    def build(rows):
        return spark.createDataFrame([(d, t, "en", None, None, "x", "y") for d, t in rows], SCHEMA)

    return build


@pytest.fixture(scope="session")
def sha():
    return lambda raw: hashlib.sha256(raw).hexdigest()
