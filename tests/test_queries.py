import re

import pytest

import __spark_entry__ as entry_points
from oracle_check import connect, difference

from conftest import SMALL

SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    frame = entry_points.queries()[name](spark, SMALL)
    assert difference(frame, duck.execute(SQL[name]).to_arrow_table()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scans_read_needed_columns_only(spark):
    text = plan(entry_points.queries()["token_stats"](spark, SMALL))
    assert re.search(r"ReadSchema: struct<text:string,lang:string,source:string>", text)
    text = plan(entry_points.queries()["bundle_export"](spark, SMALL))
    assert re.search(r"ReadSchema: struct<doc_id:bigint>", text)


def test_blocks_need_no_shuffle_after_the_batch_window(spark):
    text = plan(entry_points.queries()["pack_hash"](spark, SMALL))
    above_window = text[: text.index("Window")]
    assert "Exchange" not in above_window and "ObjectHashAggregate" in above_window
