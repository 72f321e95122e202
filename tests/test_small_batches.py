"""Tables of long texts are read, and sent to Python, in small batches."""
from commentspark.sources.tables import read_table

SETTINGS = {"spark.sql.parquet.columnarReaderBatchSize": "512", "spark.sql.execution.arrow.maxRecordsPerBatch": "500"}


def test_reading_a_table_lowers_default_batches_only(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    other.conf.set("spark.sql.parquet.columnarReaderBatchSize", "4096")
    read_table(other, "/root/testdata/sf0.001", "documents")
    assert {k: other.conf.get(k) for k in SETTINGS} == SETTINGS
    other.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "77")
    read_table(other, "/root/testdata/sf0.001", "documents")
    assert other.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "77"
