"""Every registered query against its SQL, and what their plans must not hold."""

import pathlib
import re
import sys

import pytest

from millrace.plans import ORACLES, QUERIES

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))

from check_oracles import compare, connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
WRITES = {
    "compact_hours", "custom_processor", "dedup_units_stream", "hourly_stream", "import_files", "import_files_custom", "ledger_table", "list_files", "poll_files", "read_config_tables", "read_lines",
    "read_topics", "refresh_settings", "rolled_files", "rolls_to_done", "subscriptions", "tail_files", "throughput_report", "upload_stream", "write_hourly", "write_lines", "write_topics",
}

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, db, name):
    good, note = compare(spark, db, name, SF_DIR)
    assert good, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize(("name", "most"), [("process_messages", 5), ("topic_throughput", 5), ("encode_payload", 5), ("dead_letter", 1)])
def test_payloads_are_decoded_once(spark, name, most):
    """One decode and the parses of the encoders: no filter repeats them."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= most


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_stays_in_the_jvm_without_cross_joins(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["decode_payload", "json_to_csv", "encode_payload", "dead_letter", "route", "event_time", "hour_key", "decode_values"])
def test_messages_are_not_shuffled(spark, name):
    """Work on single messages moves none of them; only the list of topics is made distinct."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert set(shuffles) <= {"topic"} and len(shuffles) <= 1


def test_scans_read_only_what_is_needed(spark):
    plan = QUERIES["status_counts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>", plan)
    plan = QUERIES["enabled_topics"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c_acctbal,0.0)" in plan
