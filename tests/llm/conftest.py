import pytest

from fleetwatt.llm.common import importable


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    importable(spark)


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with columns that results also have."""

    def make(*pairs, parts=2):
        rows = [(i, t, "en", "src", None if t is None else len(t), "x", 1.0, 7, "h") for i, t in pairs]
        schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, score double, _place int, _hit_i string"
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
