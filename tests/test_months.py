"""Facts laid out by month: what a report of a period reads."""

from decimal import Decimal

import pytest
from helpers import values

from kontor.plans import dimensions, reports
from kontor.sources.months import MONTH, read_by_month, write_by_month

FACT = "orderdatekey INT, salesterritorykey INT, salesordernumber STRING, salesamount DECIMAL(38,8)"
REGIONS = "salesterritorykey INT, salesterritorygroup STRING"


@pytest.fixture
def laid_out(frame, tmp_path, spark):
    rows = [
        (year * 10000 + month * 100 + day, day % 2, f"o{day % 3}", Decimal(day))
        for year in (2006, 2007) for month in range(1, 13) for day in range(1, 29)
    ]
    fact = frame([*rows, (None, 1, "none", Decimal(1)), (20060401, None, None, None)], FACT)
    write_by_month(fact, str(tmp_path / "fact"))
    days = dimensions.dates(spark, "2006-01-01", "2007-12-31")
    days.write.parquet(str(tmp_path / "days"))
    return fact, read_by_month(spark, str(tmp_path / "fact"), fact.schema), spark.read.parquet(str(tmp_path / "days"))


def nodes(plan):
    """All nodes of an executed plan, adaptive stages and subqueries included."""
    yield plan
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif plan.getClass().getSimpleName().endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def partitions_read(df) -> int:
    df.collect()
    found = [
        node.metrics().apply("numPartitions").value()
        for node in nodes(df._jdf.queryExecution().executedPlan())
        if node.getClass().getSimpleName() == "FileSourceScanExec" and node.metrics().contains("numPartitions")
    ]
    assert len(found) == 1
    return found[0]


def test_all_rows_come_back(laid_out):
    fact, months, _ = laid_out
    assert sorted(values(months.drop(MONTH)), key=str) == sorted(values(fact), key=str)
    assert months.select(MONTH).distinct().count() == 25


def test_a_quarter_reads_three_months(laid_out, frame):
    fact, months, days = laid_out
    regions = frame([(0, "Europe"), (1, "Asia")], REGIONS)
    quarter = days.filter("calendaryear = 2006 AND calendarquarter = 2")
    report = reports.sales_by_quarter_region(months, quarter, regions)
    assert "dynamicpruning" in report._jdf.queryExecution().executedPlan().toString()
    assert partitions_read(report) == 3
    assert values(report) == values(reports.sales_by_quarter_region(fact, quarter, regions))
    everything = reports.sales_by_quarter_region(months, days, regions)
    assert values(everything) == values(reports.sales_by_quarter_region(fact, days, regions))


def test_a_long_month_is_spread(frame, tmp_path, spark):
    rows = [(20060101, 1, f"o{i:05d}", Decimal(i)) for i in range(20_000)]
    path = str(tmp_path / "fact")
    write_by_month(frame(rows, FACT), path)
    files = spark.read.parquet(path).inputFiles()
    assert len(files) > 1 and all(f"{MONTH}=200601" in name for name in files)


def test_nothing(frame, tmp_path, spark):
    none = frame([], FACT)
    write_by_month(none, str(tmp_path / "fact"))
    assert read_by_month(spark, str(tmp_path / "fact"), none.schema).count() == 0


def test_a_fact_is_not_overwritten(laid_out, tmp_path):
    fact, _, _ = laid_out
    with pytest.raises(Exception, match="(?i)exists"):
        write_by_month(fact, str(tmp_path / "fact"))
