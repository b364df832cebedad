import pytest

from stormglass.llm.scratch import Scratch


@pytest.fixture
def scratch(spark):
    return Scratch(spark)


@pytest.fixture
def make(spark):
    """A frame from rows and a schema string; an empty list gives an empty table."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def documents(make):
    """Documents with columns that clash with names the operators use inside."""

    def build(rows):
        rows = [(*row, 1, "x") for row in rows]
        return make(rows, "doc_id bigint, text string, source string, a int, component string")

    return build


def by_id(frame, name="doc_id"):
    return {row[name]: row for row in frame.collect()}


