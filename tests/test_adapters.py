"""The sales matrix and the calendar as they are derived from rows made here."""

import re
from datetime import datetime, timedelta

import pytest

from tillcast.operators import reshape
from tillcast.plans import adapters as ad
from tillcast.plans import catalog

FIRST = datetime(1995, 1, 1)
# Order, customer, day of the matrix (1 is its first); days outside of it and orders without one or without a customer.
ORDERS = [(1, 1, 1), (2, 2, 3), (3, 1, 2405), (4, 1, 2406), (5, 1, 0), (6, 2, None), (7, None, 2), (8, 3, 3), (9, 1, 1), (7, 1, 8)]
# Order, supplier, quantity.
LINES = [
    (1, 10, 2.0), (1, 10, 3.0), (9, 10, 4.0), (3, 10, 7.0), (2, 10, 1.0), (8, 10, 5.0), (4, 11, 9.0), (5, 12, 9.0),
    (6, 13, 9.0), (7, 14, 9.0), (1, None, 6.0), (2, 15, None), (3, 15, 1.0), (99, 16, 1.0), (3, 15, 1.0),
]


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    day = lambda n: None if n is None else FIRST + timedelta(n - 1)
    # Orders without line items: as on real tables, most of what the calendar is made from.
    more = [(1000 + i, 4, i % 2400 + 1) for i in range(20000)]
    tables = {
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey long, r_name string"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey long, n_regionkey long"),
        "customer": ([(1, 0), (2, 1), (3, 1), (4, None)], "c_custkey long, c_nationkey long"),
        "orders": (
            [(o, c, day(n), "1-URGENT" if o % 2 else "5-LOW") for o, c, n in ORDERS + more],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (LINES, "l_orderkey long, l_suppkey long, l_quantity double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def wide(spark, star):
    return ad.sales_wide(spark, star)


def test_matrix_equals_brute_force(wide):
    region = {1: "ASIA", 2: "EUROPE", 3: "EUROPE"}
    want = {}
    for order, supplier, units in LINES:
        for number, customer, day in ORDERS:
            if number != order or customer not in region:
                continue
            item = None if supplier is None else f"item_{supplier}"
            cells = want.setdefault((item, region[customer], "R" if supplier is None else "ANR"[supplier % 3]), {})
            if day is not None and 1 <= day <= 2405 and units is not None:
                cells[f"d_{day}"] = cells.get(f"d_{day}", 0) + int(units)
    assert wide.columns == ["item_id", "store_id", "cat_id", *[f"d_{n}" for n in range(1, 2407)]]
    assert {t for c, t in wide.dtypes if c.startswith("d_")} == {"int"}
    rows = wide.collect()
    got = {tuple(r[:3]): {c: v for c, v in r.asDict().items() if c.startswith("d_") and v is not None} for r in rows}
    assert len(rows) == len(got) and got == want
    assert got["item_11", "ASIA", "R"] == {} and got["item_10", "ASIA", "N"] == {"d_1": 9, "d_2405": 7}


def test_no_aggregate_holds_all_days_of_an_item(spark, star):
    """A buffer of every day per item made the memory of a task grow with its items, however few days these sold on."""
    plan = ad._pivoted(spark, star)._jdf.queryExecution().sparkPlan().toString()
    assert "collect_list" in plan and "pivotfirst" not in plan
    for line in plan.splitlines():
        if "Aggregate(" in line:
            assert len(line) < 1000 and "d_2" not in line


def _exchanges(plan):
    """Exchanges of line items, their sums and the orders that meet them: keys and number of partitions."""
    found = re.findall(r"hashpartitioning\(([^()]*), (\d+)\)", plan)
    return [(re.sub(r"#\d+L?", "", keys), int(n)) for keys, n in found if re.search("l_orderkey|l_suppkey|o_orderkey", keys)]


@pytest.mark.parametrize("rows, tasks", [(1, len(LINES)), (1000, 8)])
def test_tasks_of_the_matrix_grow_with_the_line_items(spark, star, monkeypatch, rows, tasks):
    """Partitions whose number the session fixes, or that grow up to its advisory size, made a task's memory grow with the tables."""
    monkeypatch.setattr(ad, "TASK_ROWS", rows, raising=False)
    matrix = ad._pivoted(spark, star)
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert _exchanges(plan) and {n for _, n in _exchanges(plan)} == {tasks}
    assert sorted(keys for keys, _ in _exchanges(plan)) == [
        "l_orderkey", "l_orderkey, l_suppkey", "l_suppkey, r_name", "l_suppkey, r_name, day", "o_orderkey",
    ]
    # No line is summed before it is dealt: the sums would be those of a whole file split.
    lines = plan.splitlines()
    dealt = next(i for i, line in enumerate(lines) if re.search(r"hashpartitioning\(l_orderkey#\d+L, l_suppkey", line))
    read = next(i for i, line in enumerate(lines) if i > dealt and "FileScan" in line)
    assert not any("Aggregate" in line for line in lines[dealt:read])
    assert matrix.count() == ad.sales_wide(spark, star).count()


def test_matrix_files_are_dealt_without_a_sort(spark, wide, tmp_path):
    """As many files as tasks run at a time; each has the header, and the rows come back."""
    folder = catalog._csv(wide, str(tmp_path / "csv"), "item_id")
    files = list((tmp_path / "csv").glob("part-*"))
    assert 1 < len(files) <= spark.sparkContext.defaultParallelism
    assert all(f.read_text().startswith("item_id,store_id,cat_id,d_1,") for f in files)
    back = spark.read.schema(wide.schema).option("header", True).csv(folder)
    assert back.count() == wide.count() and back.exceptAll(wide).count() == 0


def test_cells_meet_the_calendar_without_a_shuffle(spark, star):
    """The calendar is as small as its days, however many orders it is made from."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50k")
    try:
        cells = spark.range(1000).selectExpr("'a' as item_id", "concat('d_', id) as d", "id as units_sold")
        joined = reshape.attach_calendar(cells, reshape.calendar_with_d(ad.calendar(spark, star)))
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin [d#" in plan and "SortMergeJoin [d#" not in plan
        assert joined.count() == 1000 and joined.filter("date is null").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_calendar_days(spark, star):
    rows = {r.date: r for r in ad.calendar(spark, star).collect()}
    assert len(rows) == 2405 and min(rows) == "1995-01-01" and max(rows) == "2001-08-01"
    known = {n for o, _, n in ORDERS if o % 2 and o % 7 == 0} | {i % 2400 + 1 for i in range(20000) if i % 2 and (1000 + i) % 7 == 0}
    days = {(FIRST + timedelta(n - 1)).strftime("%Y-%m-%d") for n in known if n}
    assert {d for d, r in rows.items() if r.event_name_1 == "Event"} == days
    assert {r.snap_CA for d, r in rows.items() if int(d[-2:]) <= 10} == {1}
