import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Rows (doc_id, text) as a ``documents`` frame with nulls elsewhere."""

    def make(rows, extra=()):
        df = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
        from pyspark.sql import functions as F

        for name in extra:
            df = df.withColumn(name, F.lit(7))
        return df.repartition(3)

    return make


@pytest.fixture
def folder(table, tmp):
    """A data folder holding ``documents`` (and ``labels``) of the given rows."""

    def make(rows, labels=()):
        table(rows).write.mode("overwrite").parquet(f"{tmp}/documents.parquet")
        spark = table(rows).sparkSession
        spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.mode(
            "overwrite").parquet(f"{tmp}/labels.parquet")
        return tmp

    return make
