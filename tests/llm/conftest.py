import duckdb
import pytest

TABLES = ["documents", "pages", "benchmark", "labels"]


@pytest.fixture(scope="session")
def duck():
    """DuckDB over the smallest tables."""
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    return connection


@pytest.fixture
def written(spark, tmp_path):
    """Rows as a Parquet table, read back."""

    def write(rows, schema, name="table"):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return write
