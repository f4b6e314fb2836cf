import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Small tables: two shuffle partitions keep the many short jobs quick."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) pairs, with a clashing extra column."""
    def make(rows):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                               T.StructField("length", T.StringType())])
        return spark.createDataFrame([(i, t, "x") for i, t in rows], schema)
    return make


def path(name):
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern():
    import public_tokenizers
    return public_tokenizers.PATTERN
