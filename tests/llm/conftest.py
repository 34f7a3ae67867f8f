import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(rows):
        full = [(i, t, *rest, None, None)[:4] + (len(t or ""),) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture
def scratch(spark):
    from codexlake.llm.common import Scratch

    return Scratch(spark, "test")
