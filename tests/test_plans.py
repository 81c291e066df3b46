"""Plan-shape guards for every registered query (see ledgerlight/plans/audit.py)."""
import pytest

from ledgerlight.plans.audit import audit
from ledgerlight.plans.registry import load_all
from tests.conftest import SF_SMALL

QUERIES = load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_nested_loop_or_python(spark, name):
    a = audit(QUERIES[name].run(spark, SF_SMALL))
    assert a["cartesian_products"] == 0, a
    assert a["nested_loop_joins"] == 0, a
    assert a["python_udf_nodes"] == 0, a


@pytest.mark.parametrize("name", ["k15_dedup", "f2_latest_per_key"])
def test_top1_is_a_window_group_limit(spark, name):
    assert audit(QUERIES[name].run(spark, SF_SMALL))["window_group_limits"] > 0
