"""Property tests of the last-wins merge against a plain-Python model."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from squall.operators.upsert import merge_last_wins

COLS = ["k", "v", "ins"]
ORDER = ["day", "pos"]

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 99),
                          st.integers(1, 3), st.integers(0, 50)), min_size=0, max_size=25)


def _df(spark, batch, ins):
    data = [(k, v, datetime(2024, 1, ins), d, p) for (k, v, d, p) in batch]
    return spark.createDataFrame(data, "k string, v int, ins timestamp, day int, pos int")


def _model(batches):
    """Sequential upserts: per key the last (day, pos) wins; ins is the first load's."""
    table = {}
    for ins, batch in batches:
        for k, v, d, p in sorted(((k, v, d, p) for k, v, d, p in batch if k is not None),
                                 key=lambda r: (r[2], r[3])):
            first = table.get(k, (None, ins))[1]
            table[k] = (v, first)
    return {k: (v, datetime(2024, 1, ins)) for k, (v, ins) in table.items()}


def _unique_order(batch):
    seen, out = set(), []
    for k, v, d, p in batch:
        if (d, p) not in seen:  # a tie in the order would make "last" ambiguous
            seen.add((d, p))
            out.append((k, v, d, p))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(b1=rows, b2=rows)
def test_merge_matches_sequential_model(spark, b1, b2):
    b1, b2 = _unique_order(b1), _unique_order(b2)
    first = merge_last_wins(None, _df(spark, b1, 1), ["k"], ORDER, ("ins",), COLS)
    second = merge_last_wins(first, _df(spark, b2, 2), ["k"], ORDER, ("ins",), COLS)
    got = {r.k: (r.v, r.ins) for r in second.collect()}
    assert got == _model([(1, b1), (2, b2)])
    # one batch holding both (b2 ordered after b1) gives the same values
    shifted = [(k, v, d + 10, p) for k, v, d, p in b2]
    together = merge_last_wins(None, _df(spark, b1 + shifted, 1), ["k"], ORDER, (), COLS[:2])
    assert {r.k: r.v for r in together.collect()} == {k: v for k, (v, _) in got.items()}
