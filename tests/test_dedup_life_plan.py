"""How the copies that are kept find their readings."""

from __future__ import annotations

from helpers import frame, instant, reading

from kilnwatch.operators.dedup import first_copies_with_life


def test_readings_are_not_sorted_whole(spark):
    rows = [reading(measured_at=instant(1000 * i), arrival_seq=i // 2) for i in range(40)]
    rows += [reading(measured_at=instant(0), arrival_seq=0)]
    kept = first_copies_with_life(frame(spark, rows), "measured_at", 10_000)
    # Few copies are kept: their readings are told apart first, and only then put in order.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    join, window = plan.index("LeftSemi"), plan.index("row_number")
    assert window < join, "a parent stands above its child"
    assert "Exchange hashpartitioning" not in plan[join:]
    assert sorted(row["arrival_seq"] for row in kept.collect()) == [0, 5, 10, 15]
