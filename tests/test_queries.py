"""Every registered query against plain SQL on another engine."""

import pytest
from compare import connect, differences

from conftest import plan
from shelftrace.plans.oracle import SQL
from shelftrace.plans.registry import QUERIES


@pytest.fixture(scope="module")
def oracle(small):
    return connect(small)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, small, name):
    wrong, size = differences(spark, oracle, small, name, QUERIES[name], SQL[name])
    assert wrong is None
    assert size > 0


def test_python_runs_for_cards_only(spark, small):
    # Those that write what they read again are not one plan; the stream has its own.
    apart = {"scd2_incremental", "csv_feed", "quarantine_split", "stage_batch", "landing_load", "cleaned_table"}
    apart |= {"load_counts", "product_ids", "landing_files", "stream_changes", "sql_cards", "crawl_order", "crawl_report", "crawl_report_capped"}
    for name in set(QUERIES) - apart:
        uses_python = "MapInArrow" in plan(QUERIES[name](spark, small))
        assert uses_python == (name in (
            "card_extract", "extract_counts", "page_catalogue", "card_catalogue", "crawl_catalogue", "card_quarantine"
        ))
        assert "BatchEvalPython" not in plan(QUERIES[name](spark, small))
