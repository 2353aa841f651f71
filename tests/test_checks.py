"""A sample of the check queries against their SQL, on the smallest tables."""

import pytest

from verification.compare import compare, load
from verification.registry import ORACLES, QUERIES

load()
SF = "/root/testdata/sf0.001"
NAMES = (
    "sensitive_key", "redact_credit_card", "scan_assignments", "external_scan_gate", "tool_arguments", "recent_message_rows",
    "cost_details", "source_metadata", "raw_trace_path", "observation_fields", "shape_raw_record", "prompt_verdicts_lifecycle",
    "tool_correlation_random", "generation_ends", "pack_batches", "update_merge",
)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    ok, text = compare(spark, SF, name)
    assert ok, text
