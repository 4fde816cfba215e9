"""A cross-section of the registered queries against their oracles; ``tests/parity.py`` runs all of them."""

from pathlib import Path

import pytest
from parity import compare

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
NAMES = ["dense_topk_routed", "hybrid_search", "section_split", "child_chunks", "category_docs", "image_triage", "image_splice", "eval_slices"]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    assert compare(spark, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name]).startswith("ok")


def test_plans_never_pair_whole_tables(spark):
    for name in ("dense_topk", "sparse_topk", "pdf_flatten", "boilerplate_lines", "unembedded_units"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan
