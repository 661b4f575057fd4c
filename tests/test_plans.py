"""No registered relational query evaluates Python per row: plans hold no Python UDF nodes."""

from conftest import SF001
from panelrank.plans import registry

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def test_no_python_udf_in_plans(spark):
    bad = {}
    for name in sorted(registry.oracle_sql()):
        df = registry.queries()[name](spark, SF001)
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = [n for n in PY_NODES if n in plan]
        if hits:
            bad[name] = hits
    assert bad == {}
