import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def frame(spark):
    """(doc_id, text) rows as a table with further columns, some named like
    the operators' own."""
    def make(rows):
        data = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "comp string, pos int").repartition(3)
    return make


@pytest.fixture()
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 7, 2.0) for i, v in rows],
                                     "vec_id long, embedding array<float>, label int, score double").repartition(3)
    return make


@pytest.fixture(scope="session")
def tokenizer_dir():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return os.path.dirname(public_tokenizers.__file__)
