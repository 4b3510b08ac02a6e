"""Plan checks: built-in functions only, pruned scans, pushed filters, no driver collects."""

import ast
import pathlib

from orderlake.plans import registry
from tests.conftest import SF0001

ROOT = pathlib.Path(__file__).resolve().parents[1] / "orderlake"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Fitted in steps; their last plan is checked with the others, their steps use built-in functions (next test but one).
FITTED = {"order_pca", "pca_explained_variance", "dbscan_orders", "cluster_distribution", "clustering_results", "cluster_scatter_bins",
          "dbscan_two_features", "two_feature_distribution", "two_feature_bins",
          "hdbscan_orders", "hdbscan_scatter_bins"}
#: Modules that bring summaries of bounded size to the driver: boxes of leaves, the last few groups or clusters, buckets of a table.
SUMMARIES = {"neighbours.py", "spanning.py", "hierarchy.py", "versioned.py"}


def test_no_python_udf_in_any_plan(spark):
    for name, fn in registry.queries().items():
        if name in FITTED:
            continue
        p = _plan(fn(spark, SF0001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_scan_is_pruned_and_filter_pushed(spark):
    df = registry.queries()["read_order"](spark, SF0001)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderkey)" in p
    hdr = _plan(registry.queries()["silver_orders_header"](spark, SF0001))
    # header only: the line table is never scanned, orders read with five columns
    assert "lineitem" not in hdr
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double," in hdr


def test_library_has_no_udfs_or_row_collects():
    banned_calls = {"udf", "pandas_udf", "collect", "toPandas", "localCheckpoint", "rdd"}
    for path in ROOT.rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:  # its operators choose their own style
            continue
        tree = ast.parse(path.read_text())
        for node in ast.walk(tree):
            if isinstance(node, ast.Attribute) and node.attr in banned_calls and not (node.attr == "collect" and path.name in SUMMARIES):
                raise AssertionError(f"{path.name}: uses .{node.attr}")


def test_items_are_shuffled_once_for_the_header_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(registry.queries()["items_with_header"](spark, SF0001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # order documents, lines, headers: the items that come out of the documents stay where they are
    assert p.count("Exchange hashpartitioning(orderId") == 3
