"""What the registered queries ask of the operators."""

import inspect
import re

from pyspark.sql import functions as F

from tillwright.plans import models, registry, reports


def test_registered_forests_have_the_default_size():
    """The size is the operator's own, which is the one asked for."""
    sizes = inspect.signature(models.train_sales_forecaster).parameters
    assert [sizes[n].default for n in ("trees", "depth", "min_leaf", "seed")] == [200, 20, 4, 42]
    assert "train_all(training(t), promotions(t), root)" in inspect.getsource(registry.model_root)


def read_rows(df):
    """Rows that the scans of a run of ``df`` give to what follows."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = [node.finalPhysicalPlan()] if node.nodeName() == "AdaptiveSparkPlan" else []
        if node.nodeName().endswith("QueryStage"):
            children.append(node.plan())
        each = node.children().iterator()
        while each.hasNext():
            children.append(each.next())
        todo += children
    return found


def test_reports_of_days_and_stores_read_a_part_of_the_clean_tables(spark, sf_dir):
    t = registry.Tables(spark, sf_dir)
    sales, features = t("silver.sales"), t("silver.features")
    whole = sales.count() + features.count()
    day = features.filter("date >= '1998-12-01'").agg(F.min("date")).first()[0]
    for report in (reports.week_snapshot(features, day), reports.sales_with_economics(sales, features, day, day)):
        plan = report._jdf.queryExecution().toString()
        scans = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
        assert scans and all("month_start" in s for s in scans), plan
        assert 0 < read_rows(report) < whole / 20
    one = reports.store_performance(sales, 1)
    assert re.search(r"PushedFilters: \[.*EqualTo\(store_id,1\)", one._jdf.queryExecution().toString())


def test_promotion_frames_come_from_the_source_asked_for(spark, sf_dir, tmp_path):
    from tillwright.sources.training import promotion_source

    warehouse = registry.warehouse(registry.Tables(spark, sf_dir))
    frame = promotion_source(spark, "silver", warehouse.root)
    assert frame.count() == warehouse.read("silver.sales").count() and "markdown5" in frame.columns
    (tmp_path / "train.csv").write_text("Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,10.5,FALSE\n2,1,2010-02-05,1,TRUE\n")
    (tmp_path / "stores.csv").write_text("Store,Type,Size\n1,A,10\n")
    header = "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday"
    (tmp_path / "features.csv").write_text(f"{header}\n1,2010-02-05,42,2.5,NA,7,NA,NA,NA,211,8,FALSE\n")
    rows = {r.store_id: (r.store_type, r.markdown1, r.markdown2) for r in promotion_source(spark, "files", str(tmp_path)).collect()}
    assert rows == {1: ("A", 0.0, 7.0), 2: (None, 0.0, 0.0)}
