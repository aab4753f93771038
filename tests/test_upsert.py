from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ludolytics.functions import ntz
from ludolytics.operators.upsert import upsert

T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)
SCHEMA = "id int, text string, votes int, fetched_at int, inserted_at timestamp_ntz, updated_at timestamp_ntz"


def merge(spark, target, source, **options):
    t = spark.createDataFrame([(*r, T0, T0) for r in target], SCHEMA)
    s = spark.createDataFrame(source, "id int, text string, votes int, fetched_at int")
    return upsert(t, s, ["id"], ntz(T1), **options)


def plain(df):
    return {r["id"]: tuple(r)[1:] for r in df.collect()}


def test_full_and_partial_update(spark):
    target = [(1, "a", 1, 1), (2, "b", 2, 1)]
    source = [(2, "B", None, 2), (3, "c", 3, 2), (None, "x", 0, 2)]
    full = plain(merge(spark, target, source))
    assert full == {
        1: ("a", 1, 1, T0, T0),
        2: ("B", None, 2, T0, T1),
        3: ("c", 3, 2, T1, T1),
    }
    partial = plain(merge(spark, target, source, update_cols=["votes", "fetched_at"]))
    assert partial[2] == ("b", None, 2, T0, T1)
    assert partial[3] == ("c", 3, 2, T1, T1)


def test_repeated_keys_follow_the_record_order(spark):
    source = [(5, "first", 1, 1), (5, "second", 2, 2), (5, "third", 3, 3)]
    assert plain(merge(spark, [], source))[5][:3] == ("third", 3, 3)
    partial = plain(merge(spark, [], source, update_cols=["votes", "fetched_at"]))
    assert partial[5][:3] == ("first", 3, 3)


def test_older_records_can_be_ignored(spark):
    target = [(1, "new", 9, 5), (2, "old", 1, 1)]
    source = [(1, "late", 0, 4), (2, "newer", 2, 2)]
    got = plain(merge(spark, target, source, newer_by="fetched_at"))
    assert got[1] == ("new", 9, 5, T0, T0)
    assert got[2] == ("newer", 2, 2, T0, T1)


def sequential(target, source, update):
    """The merge one record at a time, as a database would do it."""
    state = {r[0]: list(r[1:]) for r in target}
    for key, text, votes, at in sorted(source, key=lambda r: r[3]):
        if key is None:
            continue
        if key not in state:
            state[key] = [text, votes, at]
        else:
            if "text" in update:
                state[key][0] = text
            state[key][1:] = [votes, at]
    return {k: tuple(v) for k, v in state.items()}


row = st.tuples(
    st.integers(0, 4), st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 9))
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(row, max_size=5, unique_by=lambda r: r[0]),
    st.lists(row, max_size=8),
    st.booleans(),
)
def test_equals_sequential_merge_and_is_idempotent(spark, target, source, whole):
    target = [(*r, 0) for r in target]
    source = [(*r, n + 1) for n, r in enumerate(source)]
    update = ["text", "votes", "fetched_at"] if whole else ["votes", "fetched_at"]
    once = merge(spark, target, source, update_cols=update)
    got = {k: v[:3] for k, v in plain(once).items()}
    assert got == sequential(target, source, update)
    # Fold order must not depend on how the rows are split.
    s = spark.createDataFrame(source, "id int, text string, votes int, fetched_at int")
    again = upsert(once, s.orderBy(F.rand(1)), ["id"], ntz(T1), update_cols=update)
    assert {k: v[:3] for k, v in plain(again).items()} == got
