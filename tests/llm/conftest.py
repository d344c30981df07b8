import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text), with extra columns of clashing names."""

    def made(rows):
        schema = "doc_id bigint, text string, row int, packed string, spans string, votes int, ids string"
        return spark.createDataFrame([(*r, 1, "x", "y", 2, "z") for r in rows], schema)

    return made
