"""Ordering features carried over to new events equal one run over all of them."""
import pytest
from helpers import events_df

from eventcraft.operators import carry
from eventcraft.operators.sequence import add_first_and_elapsed, event_rank, trailing_sequence


def events(spark, n=900):
    """A device with a third of all events, a null device, null tokens, tied and null times."""
    return events_df(spark, [
        (i, "hot" if i % 3 == 0 else None if i % 41 == 0 else f"d{i % 29}",
         None if i % 11 == 0 else f"e{i % 17}", None if i > n - 20 else 1000 * (i // 4), {})
        for i in range(n)])


def whole(df):
    r = trailing_sequence(event_rank(add_first_and_elapsed(df.where("did is not null"))), "eid", pad="0")
    return {x.row_id: (x.event_rank, x.first_eid, x.time_since_first, x.seq) for x in r.collect()}


def rows_of(df):
    return {x.row_id: (x.event_rank, x.first_token, x.time_since_first, x.seq)
            for x in df.where("did is not null").collect()}


def test_three_batches_equal_one_run(spark):
    df = events(spark)
    want = whole(df)
    state = carry.history_state(df.where("row_id < 250"))
    got = {}
    for lo, hi in ((250, 600), (600, 900)):
        out, state = carry.continue_events(state, df.where(f"row_id >= {lo} and row_id < {hi}"))
        state = state.checkpoint()
        got |= rows_of(out)
    assert got == {k: v for k, v in want.items() if k >= 250}
    full = carry.history_state(df)
    assert sorted(map(str, state.select(full.columns).collect())) == sorted(map(str, full.collect()))
    assert state.where("did is null").count() == 1


def test_histories_merge_in_any_order(spark):
    df = events(spark, 300)
    full = carry.history_state(df)
    a, b, c = (carry.history_state(df.where(f"row_id % 3 = {k}")) for k in range(3))
    for x in (carry.merge_histories(carry.merge_histories(a, b), c),
              carry.merge_histories(c, carry.merge_histories(b, a))):
        assert sorted(map(str, x.select(full.columns).collect())) == sorted(map(str, full.collect()))


def test_empty_sides(spark):
    df = events(spark, 200)
    none = df.where("false")
    out, state = carry.continue_events(carry.history_state(none), df)
    assert rows_of(out) == whole(df)
    out, again = carry.continue_events(state, none)
    assert out.count() == 0
    assert sorted(map(str, again.collect())) == sorted(map(str, state.select(again.columns).collect()))


def test_late_events_are_named_and_refused(spark):
    df = events(spark, 200)
    state = carry.history_state(df.where("row_id >= 100"))
    late = carry.late_events(state, df.where("row_id < 100"))
    assert late.count() > 0
    with pytest.raises(ValueError, match="late_events"):
        carry.continue_events(state, df.where("row_id < 100"))


def test_a_task_passes_on_a_bounded_tail(spark):
    plan = carry.history_state(events(spark, 50))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
