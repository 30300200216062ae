"""I-08 shuffles the client's text, not its digest."""

import hashlib

from leadlens.plans import identity as I
from tests.test_profiles import _tables


def test_timeline_numbers_and_key(spark):
    df = I.client_timeline(*_tables(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(client_id" in line], plan
    rows = df.collect()
    assert len(rows) == 11
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    first = sorted((r.seq, r.source, r.rec_id) for r in rows if r.client_id == md5("s:71"))
    assert first == [(1, "gsheets", "20"), (2, "yclients", "11"), (3, "amo", "1"), (4, "yclients", "10")]
    assert sorted(r.seq for r in rows if r.client_id == md5("74") and r.studio_id is None) == [1, 2]
