import datetime as dt
import os
import random

import pytest

from lakestrata.plans import current, ingest
from lakestrata.plans.current import current_rows, fold, newest_version, vacuum_current
from lakestrata.plans.gold import build_gold, read_bronze
from lakestrata.plans.lake import Lake
from lakestrata.specs import Pattern, TableSpec, spec
from tests.conftest import rows

LINES = TableSpec("lines", "lines", Pattern.INCREMENTAL, timestamp_column="at", keys=("k", "n"))
SCHEMA = "k string, n int, at timestamp_ntz, v int"


def load(spark, lake, data, hour, s=LINES, **kwargs):
    df = spark.createDataFrame(data, SCHEMA)
    return ingest.ingest_table(spark, s, lake, f"2025-01-01-{hour:02}", lambda _: df, **kwargs)


def at(hour):
    return dt.datetime(2025, 1, 1, hour)


def rule(batches):
    """Every row of each whole key's newest batch; rows with a null in the key always."""
    newest = {}
    for i, batch in enumerate(batches):
        for k, n, *_ in batch:
            newest[k, n] = i
    return sorted((r[0] or "", r[1] or 0, r[3]) for i, batch in enumerate(batches) for r in batch
                  if None in r[:2] or newest[r[0], r[1]] == i)


def got(df):
    return sorted((r.k or "", r.n or 0, r.v) for r in df.collect())


@pytest.mark.parametrize("buckets", [None, 7])
def test_any_number_of_batches_follows_one_rule(spark, lake_root, buckets):
    rng, lake, batches = random.Random(3), Lake(lake_root), []
    for hour in range(5):
        batch = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), at(hour + 1), hour * 100 + i)
                 for i in range(12 if hour else 40)]
        batch += batch[:3]  # what a source repeats
        assert load(spark, lake, batch, hour)["rows_synced"] == len(batch)
        batches.append(batch)
        if hour != 3:  # one build skips a batch and folds two at once
            assert got(current_rows(spark, lake, LINES, buckets)) == rule(batches)
    assert got(current_rows(spark, lake, LINES, buckets)) == rule(batches)  # nothing new: the same version
    assert len(current._versions(spark, lake, "lines")) == 3


def test_a_delta_reads_itself_and_rewrites_its_buckets_only(spark, lake_root):
    lake = Lake(lake_root)
    load(spark, lake, [(f"k{i}", i, at(1), i) for i in range(2000)] + [(None, i, at(1), i) for i in range(900)], 0)
    load(spark, lake, [("k1", 1, at(2), -1)], 1)
    first = fold(spark, lake, LINES, 32)
    folder = lake_root.removeprefix("file:") + "/bronze/lines"
    for path, _, names in os.walk(folder):  # the batches that are folded in are not needed again
        for name in names:
            os.rename(f"{path}/{name}", f"{path}/_unread-{name}")
    load(spark, lake, [("k7", 7, at(3), -7), ("k7", 7, at(3), -8), (None, 7, at(3), -9)], 2)
    second = fold(spark, lake, LINES, 32)
    changed = {b for b in first.folders if first.folders[b] != second.folders[b]}
    assert len(changed - {"-1"}) == 1 and len(second.folders["-1"]) == 2
    assert set(first.folders["-1"]) < set(second.folders["-1"])
    values = {r.v for r in current_rows(spark, lake, LINES).collect()}
    assert values >= {-1, -7, -8, -9, 6, 8} and current_rows(spark, lake, LINES).count() == 2000 + 1 + 901
    assert newest_version(spark, lake, "lines") == second


def test_the_log_decides_whether_a_state_still_fits(spark, lake_root):
    lake = Lake(lake_root)
    a, b, c = (("a", 1, at(1), 1), ("a", 1, at(2), 2), ("b", 1, at(3), 3))
    load(spark, lake, [a], 0)
    load(spark, lake, [a, b], 1)
    assert got(current_rows(spark, lake, LINES)) == [("a", 1, 2)]
    load(spark, lake, [c], 2, force_full=True)  # everything before is gone
    assert got(current_rows(spark, lake, LINES)) == [("b", 1, 3)]
    load(spark, lake, [c, ("b", 1, at(4), 4)], 3)
    assert got(current_rows(spark, lake, LINES)) == [("b", 1, 4)]
    wider = TableSpec("lines", "lines", Pattern.INCREMENTAL, timestamp_column="at", keys=("k", "v"))
    assert got(current_rows(spark, lake, wider)) == [("b", 1, 3), ("b", 1, 4)]  # other keys: built anew


def test_a_load_that_began_earlier_and_committed_later_does_not_win(spark, lake_root):
    lake = Lake(lake_root)
    load(spark, lake, [("a", 1, at(1), 1)], 0)

    def slow(_):
        load(spark, lake, [("a", 1, at(3), 3)], 1)
        current_rows(spark, lake, LINES)
        return spark.createDataFrame([("a", 1, at(2), 2)], SCHEMA)

    made = iter(["20250101T000000000000-slow"])
    before = ingest.new_batch_id
    ingest.new_batch_id = lambda: next(made, None) or before()
    try:
        def reader(s):
            ingest.new_batch_id = before
            out = slow(s)
            ingest.new_batch_id = lambda: next(made, None) or before()
            return out
        ingest.ingest_table(spark, LINES, lake, "2025-01-01-02", reader)
    finally:
        ingest.new_batch_id = before
    assert got(current_rows(spark, lake, LINES)) == [("a", 1, 3)]


def test_vacuum_keeps_what_the_newest_version_needs(spark, lake_root):
    lake = Lake(lake_root)
    for hour in range(4):
        load(spark, lake, [("a", hour % 2, at(hour + 1), hour), (None, 1, at(hour + 1), hour)], hour)
        if hour:
            want = got(current_rows(spark, lake, LINES, 4))
    assert vacuum_current(spark, lake, "lines") == []  # replaced a moment ago
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=2)
    dropped = vacuum_current(spark, lake, "lines", now=later)
    assert sum(d.startswith("versions/") for d in dropped) == 2 and any(d.startswith("data/") for d in dropped)
    assert got(current_rows(spark, lake, LINES, 4)) == want


def test_default_scope_equals_at_one_two_and_three_batches(spark, lake_root):
    """Gold does not change when a run adds nothing, however many batches there are."""
    lake, s = Lake(lake_root), spec("order_item")
    schema = "co_num string, co_line int, item string, qty_ordered string, qty_shipped string, cost string, price string, " \
             "description string, RecordDate timestamp_ntz"
    data = [("CO1", 1, "P", "1", "1", "1", "1", "d", at(1)), ("CO1", 1, "Q", "1", "1", "1", "1", "d", at(1)),
            (None, 1, "R", "1", "1", "1", "1", "d", at(1)), (None, 1, "R", "1", "1", "1", "1", "d", at(1))]
    extra = ("CO2", 1, "S", "1", "1", "1", "1", "d", at(2))
    for hour, n in ((0, 4), (1, 5), (2, 5)):
        df = spark.createDataFrame(data + [extra] * bool(hour), schema)
        ingest.ingest_table(spark, s, lake, f"2025-01-01-0{hour}", lambda _: df)
        assert build_gold(spark, lake, ["fact_order_item"])["fact_order_item"].rows == n
    assert len(rows(read_bronze(spark, lake, "order_item")[0])) == 5
    with pytest.raises(ValueError, match="keys"):
        fold(spark, lake, TableSpec("x", "order_item"))
