import pytest


@pytest.fixture
def docs(spark):
    """Builds documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def build(rows, **extra):
        names = {"n": "long", "key": "string", "file": "string", "row": "long", "bucket": "int", **extra}
        schema = "doc_id long, text string, " + ", ".join(f"{k} {v}" for k, v in names.items())
        return spark.createDataFrame([(*r, *([None] * len(names))) for r in rows], schema)

    return build
