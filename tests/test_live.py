"""Live counts kept by a stream, against the batch operator as of the stream's clock."""

import datetime as dt
import os
import random

import pytest

from kerbside.operators import flow
from kerbside.streaming.live import LiveFlow
from tests.test_levels import PASSES, T0, rows


def test_after_each_batch_as_of_its_clock(spark, tmp_path):
    chance, state, seen = random.Random(5), LiveFlow(str(tmp_path)), []
    for batch in range(6):
        # Half an hour a batch, some passes up to two hours late, over midnight; one batch is empty, one is replayed.
        start = dt.datetime(2024, 1, 1, 22) + dt.timedelta(minutes=30 * batch)
        added = [] if batch == 3 else [
            (chance.choice(["1", "2", None]), chance.randrange(2),
             start + dt.timedelta(seconds=chance.randrange(1800) - (chance.randrange(7200) if i % 5 == 0 else 0)), i, 1.0, 2.0)
            for i in range(40)
        ]
        if batch == 4:
            added.append(("1", 0, None, 99, 1.0, 2.0))
        for _ in range(2 if batch == 2 else 1):
            state.add(spark.createDataFrame(added, PASSES), batch)
        seen += [a for a in added if a[2]]
        if batch in (0, 2, 4, 5):
            want = flow.flow_live_asof(spark.createDataFrame(seen, PASSES), max(s[2] for s in seen))
            assert rows(state.read(spark)) == rows(want)
    assert len([f for f in os.listdir(tmp_path) if f[0].isdigit()]) == 3


def test_a_minute_whose_first_pass_has_gone_does_not_come_back(spark, tmp_path):
    state = LiveFlow(str(tmp_path))

    def add(batch, *seconds):
        state.add(spark.createDataFrame([("1", 0, T0 + dt.timedelta(seconds=s), batch * 10 + i, 1.0, 2.0) for i, s in enumerate(seconds)], PASSES), batch)
        return {(r.grain, r.bucket): r.n for r in state.read(spark).collect()}

    add(0, 5, 30)
    gone = add(1, 615)  # the pass at 5 has left, the one at 30 has not
    assert ("minute", T0) not in gone and gone[("hour", T0)] == 3
    again = add(2, 40)  # comes for the same minute
    assert ("minute", T0) not in again and again[("hour", T0)] == 4


def test_a_state_without_batches_says_so(spark, tmp_path):
    with pytest.raises(ValueError):
        LiveFlow(str(tmp_path)).read(spark)
