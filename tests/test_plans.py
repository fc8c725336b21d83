"""What the plans look like when no side is small enough to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from restframe.operators.lookup import lookup_join
from restframe.operators.sequence import last_value_before, number_rows, number_runs
from restframe.plans.base import table
from restframe.plans.joins import CUSTOMER, _customer_endpoint
from restframe.sources.transport import CallableTransport, TableTransport
from restframe.spec import ARRAY, LookupSpec


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def wide_shuffles(text, column):
    """Shuffles whose input still holds the wide column."""
    lines = text.split("\n")
    return sum(
        "Exchange hashpartitioning" in line and any(column in below for below in lines[i + 1 : i + 2])
        for i, line in enumerate(lines)
    )


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: number_rows(df, ["lane"], ["slice"], ["doc_id"]),
        lambda df: number_runs(df, ["lane"], ["slice"], ["doc_id"], F.col("lang")),
        lambda df: last_value_before(df, ["lane"], ["slice"], ["doc_id"], F.col("lang"), "before"),
    ],
)
def test_slices_shuffle_wide_rows_once(spark, sf_dir, no_broadcast, operator):
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang", "text", "doc_id % 3 as lane", "doc_id div 10 as slice"
    )
    text = plan(operator(documents))
    assert wide_shuffles(text, "text#") == 1
    assert "BroadcastExchange" not in text


def test_lookup_join_reads_only_what_it_needs(spark, sf_dir, no_broadcast):
    joined = lookup_join(
        table(spark, sf_dir, "orders"),
        CUSTOMER,
        {"c_custkey": "o_custkey"},
        _customer_endpoint(spark, sf_dir),
        select=["c_name"],
        keep=["o_orderkey"],
    )
    text = plan(joined)
    scans = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert scans <= {
        "o_orderkey:bigint,o_custkey:bigint",
        "o_custkey:bigint",
        "c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string",
    }
    # Requests are built behind the aggregation that makes keys distinct, never on probe rows.
    probe_side = text.split("SortMergeJoin")[1].split("Generate explode")[0]
    assert "sha2" not in probe_side and "PushedFilters: [IsNotNull(o_custkey)]" in text


def test_uncached_lookup_has_no_shuffle(spark, sf_dir):
    spec = CUSTOMER.replace(cache="NONE")
    echo = CallableTransport(lambda request: {"status": 200, "body": "{}"})
    joined = lookup_join(
        table(spark, sf_dir, "orders"), spec, {"c_custkey": "o_custkey"}, echo, select=["c_name"], keep=["o_orderkey"]
    )
    assert "Exchange" not in plan(joined)


@pytest.mark.parametrize("skew", [True, False])
@pytest.mark.parametrize("result_type", ["single-value", ARRAY])
def test_documents_and_keys_as_text_are_never_broadcast(spark, tmp_path, result_type, skew):
    """A file of some kilobytes may be a table of any size as documents and as JSON keys."""
    made = spark.range(300).selectExpr("id", "map('k', id % 200) as place", "concat('n', id % 200) as name")
    made.union(spark.sql("select 300L, null, null")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    spec = LookupSpec(url="http://places.example.com/", schema="place map<string,bigint>, name string", method="POST",
                      result_type=result_type)
    served = TableTransport(rows.where("id < 200").select("place", "name"), ["place"])
    joined = lookup_join(rows.select("id", F.col("place").alias("at")), spec, {"place": "at"}, served, how="left",
                         select=["name"], keep=["id"], skew=skew)
    assert sorted(map(tuple, joined.collect())) == [*((i, f"n{i % 200}") for i in range(300)), (300, None)]
    text = plan(joined).split("== Initial Plan ==")[0]
    joins = re.findall(r"(\w+Join) \[(request_id|_key)#", text)
    assert {key for _, key in joins} == {"request_id", "_key"}
    assert all(kind == "SortMergeJoin" for kind, _ in joins), joins
