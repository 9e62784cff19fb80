"""Results do not depend on partitioning (S11: order-dependent operators use
explicit orders). Same queries, different shuffle partition counts, with and
without adaptive execution."""

import pytest

import __spark_entry__ as entry
from tools.compare import compare

SF = "/root/testdata/sf0.001"
ORDER_SENSITIVE = ["dedupe_first", "main_group", "new_from_cumulative", "bulletin_fact", "dbscan_1d",
                   "lag_correlation_best", "longest_prefix", "block_parse", "auc_score"]


@pytest.mark.parametrize("name", ORDER_SENSITIVE)
def test_partitioning_invariance(spark, name):
    q = entry.queries()[name]
    base = q(spark, SF).toPandas()
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for parts, aqe in (("3", "true"), ("17", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            ok, exact, msg = compare(q(spark, SF).toPandas(), base)
            assert ok and exact, msg
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
