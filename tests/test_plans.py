"""Plan shape: pruning reaches the scan, no Python in the row path, the
hot-key LAG is bucketed."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_udfs(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in plan, (name, marker)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["conversation_summary"](spark, SF_SMALL))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line and "events" in plan]
    assert schemas
    for line in schemas:
        assert "value" not in line.split("ReadSchema:")[1]


def test_hot_keys_have_a_branch_of_their_own(spark):
    plan = _plan(entry.queries()["conversation_summary"](spark, SF_SMALL))
    assert "_lag_b" in plan and "_lag_cuts" in plan


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_nothing_is_left_of_the_hot_branch_without_hot_keys(spark):
    final = _final_plan(entry.queries()["raw_response_times"](spark, SF_SMALL))
    assert "_lag_b" not in final


def test_messages_are_aggregated_by_hashing(spark):
    """No sort aggregate over messages or pairs, no row per distinct column."""
    assert "SortAggregate" not in _final_plan(entry.queries()["legacy_enhanced_summary"](spark, SF_SMALL))
    assert "Expand" not in _final_plan(entry.queries()["user_report"](spark, SF_SMALL))
    final = _final_plan(entry.queries()["raw_response_times"](spark, SF_SMALL))
    over_pairs = [line for line in final.splitlines() if "Aggregate(" in line and "order_key" in line]
    assert over_pairs and all("HashAggregate" in line for line in over_pairs)


def test_bucketed_events_are_not_exchanged(spark, tmp_path):
    from parley.plans import conversation
    from parley.sources import fixtures, layout

    events = fixtures.load_table(spark, SF_SMALL, "events")
    me, wh = fixtures.message_events(events), fixtures.working_hours(events)
    table = "bucketed_events_test"
    layout.write_bucketed_events(me, table, str(tmp_path / "events"), buckets=4)
    try:
        got = conversation.conversation_summary_flat(layout.read_bucketed_events(spark, table), wh)
        final = _final_plan(got)
        scans = [line for line in final.splitlines() if "FileScan" in line and "bucketed_events_test" in line]
        assert scans and all("Bucketed: true" in line for line in scans)
        # Exchanges move calendars only: none by chat.
        exchanges = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and not [line for line in exchanges if "chat_id" in line]
        want = conversation.conversation_summary_flat(me, wh)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    finally:
        spark.sql(f"DROP TABLE {table}")
