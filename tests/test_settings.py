from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import settings
from millrace.queries import QUERIES, load_all
from tests.conftest import rows


def test_masked_records_equal_masked_entries(spark):
    df = spark.createDataFrame([("a", {"db.password": "p", "host": "h", "api.key": "${file:x}", "token": None}), ("b", {}), (None, None)],
                               "record_id string, settings map<string,string>")
    entries = df.select("record_id", F.explode("settings"))
    assert rows(settings.mask_settings(df).select("record_id", F.explode("settings"))) == rows(settings.mask_secrets(entries))


def test_masked_records_are_dealt_before_they_are_sorted(spark, tmp_path):
    spark.sql("SELECT 1L o_orderkey, 2L o_custkey, 'F' o_orderstatus, '5-LOW' o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    load_all()
    found = QUERIES["a26_mask_secrets"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and plan.rindex("SortAggregate") < plan.index("hashpartitioning(record_id")
    assert rows(found) == [("1", "${MASKED_CONNECTION.PASSWORD}", "h2", "${MASKED_KEY.CONVERTER.SCHEMA.REGISTRY.URL}", 2)]
