"""Plan-shape regression tests: the scale properties the README claims."""

import re

import pytest

from cartwheel.plans import registry as E
from cartwheel.sources.sessions import load_sessions
from tests.conftest import SF_SMALL

FIT = {"production_candidates_validation", "engineered_sweep_validation", "calibrated_scores_check",
       "stacking_validation", "cv_search_validation", "focal_refit_validation"}
NAMES = sorted(set(E.queries()) - FIT)
BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


# Windows allowed without a partition key: they run over tables bounded by construction —
# bucket totals (``*_tot``, ≤ #buckets rows), the 99-row cost grid (pos / neg per grid index)
# and the per-class counts (two rows).
BOUNDED_WINDOW_INPUTS = {"pos", "neg", "sessions", "_w0"}


def _unpartitioned_window_inputs(plan: str) -> list[set]:
    out = []
    for line in plan.splitlines():
        if "Window [" not in line:
            continue
        m = re.search(r"\], \[([^\[\]]*)\], \[([^\[\]]*)\]\s*$", line)
        if m is None or not m.group(1).strip():
            out.append(set(re.findall(r"sum\((\w+)#", line)))
    return out


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_python_nodes(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BAD if b in plan]
    for inputs in _unpartitioned_window_inputs(plan):
        assert all(c.endswith("_tot") or c in BOUNDED_WINDOW_INPUTS for c in inputs), inputs


def test_sessions_scan_is_pruned(spark):
    plan = load_sessions(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"ts", "user_id", "event_type", "value", "props"}  # event_id is never read


def test_filters_reach_the_scan(spark):
    df = load_sessions(spark, SF_SMALL).filter("user_id = 7")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in plan
