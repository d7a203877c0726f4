"""Plan rules over every registered query (planning only): no cartesian
products, no Python UDFs, no nested-loop joins."""

import pytest

from explain_plans import plan_text, summarise
from ledgerflow.plans.catalog import REGISTRY

from .conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_rules(spark, name):
    s = summarise(plan_text(REGISTRY[name].build(spark, SF_SMALL)))
    assert s["cartesian"] == 0
    assert s["python_udf"] == 0
    assert s["nested_loop"] == 0
