import pytest
from oracle import rows_of_query, rows_of_sql

from quillspark.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, data, name):
    df = catalogue.queries()[name](spark, data)
    columns = sorted(df.columns)
    assert rows_of_query(df, columns) == rows_of_sql(catalogue.oracle_sql()[name], data, columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_runs(spark, data, name):
    assert catalogue.queries()[name](spark, data).count() > 0


def test_entry_has_rows_and_all_sql_has_a_query(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
