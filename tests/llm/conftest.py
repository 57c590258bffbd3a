import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (id, text) pairs, dealt over several partitions."""

    def make(rows, extra=""):
        schema = COLUMNS + (f", {extra}" if extra else "")
        width = schema.count(",") + 1
        return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema).repartition(3)

    return make
