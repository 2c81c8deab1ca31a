"""Every query of the registry against its SQL, and what the registry promises."""

import pytest
from conftest import SMALL

from gridloom.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, spark, tables, same_rows):
    same_rows(QUERIES[name](spark, SMALL), tables.sql(ORACLES[name]))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_drawn_pages_give_the_drawn_blocks(spark):
    rows = QUERIES["raster_blocks"](spark, SMALL).collect()
    suppliers = [r[0] for r in spark.read.parquet(f"{SMALL}/supplier.parquet").select("s_suppkey").collect()]
    assert len(rows) == sum(n % 7 for n in suppliers)
