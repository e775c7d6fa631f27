"""How often the ingests do their costly work."""

from datetime import datetime

import pytest

from brightweir.functions.dates import parse_absolute
from brightweir.functions.text import is_blank
from brightweir.operators import resolve
from brightweir.plans import workload as w


def _plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def tables(spark, tmp_path):
    """Orders of two pages, with repeated and null keys."""
    day = datetime(2024, 1, 2)
    orders = [(k, 1 + (k or 0) % 3, day, "1-URGENT") for k in (None, 0, 1, 6, 6, 12, 13, 249, 250, 252)]
    customers = [(1, "A", "AUTOMOBILE"), (2, "B & C", "FURNITURE"), (3, None, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_accents_are_folded_per_distinct_name(spark):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(["Café A", "Café A", "b", None, " "])], "i long, name string")
    names = resolve.normalized_names(rows, "name").where("normal <> ''")
    text = _plan(names)
    # The Python step stands above the grouping only, though a filter reads its result.
    assert text.index("ArrowEvalPython") < text.index("Aggregate") and text.rindex("ArrowEvalPython") < text.rindex("Aggregate")
    assert sorted((r.name, r.n_rows, r.normal) for r in names.collect()) == [("Café A", 2, "cafe a"), ("b", 1, "b")]


def test_job_items_read_the_orders_once(spark, tables):
    items = w.derived(spark, tables, w.job_items)
    assert _plan(items, "optimizedPlan").count("Relation [o_orderkey") == 1
    # The rows are those of the two branches that the reference SQL has.
    base = items.where("seq is null or seq % 2 = 0").drop("seq")
    both = base.selectExpr("*", "k * 2 as seq").unionAll(base.where("k % 6 = 0").selectExpr("*", "k * 2 + 1 as seq"))
    assert items.exceptAll(both).count() == 0 and both.exceptAll(items).count() == 0 and items.count() == 15


def test_pages_of_jobs_are_not_merged_by_size(spark, tables):
    pages = w.landed_jobs(spark, tables)
    assert "REPARTITION_BY_NUM" in _plan(pages)
    assert sum(r.payload.count("2024-01-") + r.payload.count("Jan 2024") + r.payload.count('"created_at"') for r in pages.where("page is not null").collect()) >= 14


def test_dates_and_blanks_keep_their_meaning(column_values):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02 03:04:05", "2024-02-30 03:04:05", "2024-01-02T03:04:05\n", " 2024-01-02 03:04:05 ",
             "Tue, 02 Jan 2024 03:04 EST", "02 jan 2024 3:04:05 +0200", "2 Feb 2024 3:04 QQQ", None, ""]
    got = [None if t is None else str(t) for t in column_values(parse_absolute, texts)]
    three = "2024-01-02 03:04:05"
    assert got == [three, three, None, three, three, "2024-01-02 08:04:00", "2024-01-02 01:04:05", None, None, None]
    blanks = [None, "", " \t\n\x1c", " 　\x85", "x", " x\n", "​", "\n\n.\n"]
    assert column_values(is_blank, blanks) == [True, True, True, True, False, False, False, False]
