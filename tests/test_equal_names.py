"""I-06: records of equal names are settled before similar names are looked for."""

import datetime as dt

from leadlens.plans import identity as I

RECORD = "studio_id string, rec_id string, name string, ts timestamp_ntz"


def test_similar_names_are_looked_for_among_the_rest_only(spark, monkeypatch):
    seen, plain = [], I._similar_names

    def similar(a, b, keys, min_sim):
        seen.append((sorted({r.name for r in a.collect()}), sorted({r.other for r in b.collect()})))
        return plain(a, b, keys, min_sim)

    monkeypatch.setattr(I, "_similar_names", similar)
    at = dt.datetime(2024, 1, 5, 12)
    row = lambda i, name, hours=0: ("s", i, name, at + dt.timedelta(hours=hours))
    left = [row("a", "petr ivanov 1"), row("b", "petr ivanov 2"), row("c", "petr ivanov 3"), row("e", "petr ivanov 1", 30)]
    right = [row("v", "petr ivanov 1"), row("w", "petr ivanov 2", 1)]
    run = lambda r: sorted(tuple(x) for x in I.assign_by_time(
        spark.createDataFrame(left, RECORD), spark.createDataFrame(r, RECORD)).collect())
    equal = [("s", "a", "v", 1.0), ("s", "b", "w", 1.0)]
    assert run(right) == equal and seen == []
    assert run([*right, row("x", "petr ivanov 4", 2)]) == [*equal, ("s", "c", "x", 0.9231)]
    assert seen == [(["petr ivanov 1", "petr ivanov 3"], ["petr ivanov 4"])]
