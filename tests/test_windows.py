"""History features: frame edges, ties, and the plan for busy customers."""

import random
import uuid
from bisect import bisect_left, bisect_right
from dataclasses import replace
from datetime import timedelta

import pytest
from conftest import START, txn
from pyspark.sql import functions as F

from tidewatch.config import Rules, Scale
from tidewatch.operators.history import busy_customers, row_cutoff, with_history
from tidewatch.operators.prefix import prefix_scan
from tidewatch.operators.rules import score_transactions

WEEK = 7 * 86_400
ALL_SPLIT = Scale(busy_rows=0)
PLANS = {"whole": {"split": False}, "split": {"split": True, "scale": ALL_SPLIT}}


def by_id(df):
    return {r.transaction_id: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("plan", PLANS)
def test_frame_holds_both_ends_of_seven_days(frame, plan):
    got = by_id(with_history(frame([txn(1), txn(2, WEEK), txn(3, WEEK + 1)]), **PLANS[plan]))
    assert got["T00000002"]["rolling_7d_count"] == 2
    assert got["T00000003"]["rolling_7d_count"] == 2  # the first row is 604 801 s back


@pytest.mark.parametrize("plan", PLANS)
def test_open_frame_leaves_out_the_far_end_and_later_ties(frame, plan):
    rows = frame([txn(1), txn(2, WEEK), txn(3, WEEK), txn(4, WEEK + 0.000001)])
    got = by_id(with_history(rows, open_window=True, **PLANS[plan]))
    assert [got[f"T0000000{i}"]["rolling_7d_count"] for i in (1, 2, 3, 4)] == [1, 1, 2, 3]


@pytest.mark.parametrize("plan", PLANS)
def test_rows_of_one_second_see_each_other_and_keep_a_fixed_order(frame, plan):
    rows = frame([txn(2, 0.5, 20.0), txn(1, 0.5, 10.0), txn(3, 0.25, 5.0)])
    got = by_id(with_history(rows, **PLANS[plan]))
    assert {r["rolling_7d_count"] for r in got.values()} == {3}
    assert {r["rolling_7d_amount"] for r in got.values()} == {35.0}
    assert [got[f"T0000000{i}"]["cumulative_amount"] for i in (3, 1, 2)] == [5.0, 15.0, 35.0]
    assert got["T00000002"]["prev_timestamp"] == START + timedelta(seconds=0.5)
    assert got["T00000003"]["prev_timestamp"] is None


@pytest.mark.parametrize("plan", PLANS)
def test_null_amount_counts_as_row_but_not_in_the_average(frame, plan):
    got = by_id(with_history(frame([txn(1, 0, None), txn(2, 10, 30.0)]), **PLANS[plan]))
    assert got["T00000001"]["rolling_7d_amount"] is None
    assert got["T00000001"]["rolling_7d_avg"] is None
    assert got["T00000001"]["cumulative_amount"] is None
    assert got["T00000002"]["rolling_7d_count"] == 2
    assert got["T00000002"]["rolling_7d_avg"] == 30.0


def crowd(seed, n=900):
    """A third of the rows on one customer, many of them at the same instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        customer = "HOT" if i % 3 == 0 else f"C{rng.randrange(40):03d}"
        when = rng.choice([0, 0, 86_400 * 3, rng.randrange(30 * 86_400), rng.randrange(30 * 86_400) + 0.25])
        rows.append(txn(i, when, rng.randrange(1, 1_000_000) / 100, customer))
    return rows


def expected(rows, open_window):
    """Straight from the definitions, in Python."""
    people = {}
    for r in rows:
        micros = round((r[9] - START).total_seconds() * 1e6)
        people.setdefault(r[1], []).append((micros // 10**6, micros, r[0], round(r[4] * 100), r[9]))
    out = {}
    for mine in people.values():
        mine.sort()
        seconds, instants = [m[0] for m in mine], [m[1] for m in mine]
        for at, (s, us, tid, _, ts) in enumerate(mine):
            if open_window:
                lo, hi = bisect_right(instants, us - WEEK * 10**6), at + 1
            else:
                lo, hi = bisect_left(seconds, s - WEEK), bisect_right(seconds, s)
            total = sum(m[3] for m in mine[lo:hi])
            out[tid] = (
                total / 100,
                hi - lo,
                sum(m[3] for m in mine[: at + 1]) / 100,
                at + 1,
                mine[at - 1][4] if at else None,
            )
    return out


@pytest.mark.parametrize("open_window", [False, True])
@pytest.mark.parametrize("cutoff", [None, 0, 12, 100, 10**9])
def test_all_plans_match_the_definitions(frame, open_window, cutoff):
    rows = crowd(7)
    how = {"split": False} if cutoff is None else {"split": True, "scale": Scale(busy_rows=cutoff)}
    got = {
        r.transaction_id: (
            r.rolling_7d_amount,
            r.rolling_7d_count,
            r.cumulative_amount,
            r.cumulative_count,
            r.prev_timestamp,
        )
        for r in with_history(frame(rows), open_window=open_window, **how).collect()
    }
    assert got == expected(rows, open_window)


def test_busy_list_has_only_the_busy_and_is_bounded(frame):
    rows = frame(crowd(3))

    def busy(scale):
        return [r[0] for r in busy_customers(rows, row_cutoff(rows, scale)).collect()]

    assert busy(Scale(busy_rows=100)) == ["HOT"]
    assert len(busy(Scale(busy_rows=0))) == 41
    # However low the limit, no more than 3 customers can hold over a third.
    assert len(busy(Scale(busy_rows=0, max_busy_customers=3))) <= 3


def named(rng, kind, i):
    if kind == "mixed":
        return str(rng.choice([i, 10**7 + i, 10**12 + i * 7]))
    return str(uuid.UUID(int=rng.getrandbits(128)))


@pytest.mark.parametrize("kind", ["mixed", "random"])
@pytest.mark.parametrize("open_window", [False, True])
def test_both_plans_agree_whatever_the_ids_look_like(frame, kind, open_window):
    rng = random.Random(11)
    rows, seen = [], set()
    for i in range(500):
        when = rng.choice([0, 86_400 * rng.randrange(4), 86_400 * 2, rng.randrange(10 * 86_400)])
        row = list(txn(i, when, rng.choice([0.004, 0.125, 17.5, None]), rng.choice(["HOT", "HOT", "B", None])))
        row[0] = named(rng, kind, i)
        if rng.random() < 0.02:
            row[9] = None
        if row[0] not in seen:
            seen.add(row[0])
            rows.append(tuple(row))
    plans = [{"split": False}, {"split": True, "scale": ALL_SPLIT}, {"split": True, "scale": Scale(busy_rows=40)}]
    got = [by_id(with_history(frame(rows), open_window=open_window, **how)) for how in plans]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(rows)
    for r in got[0].values():
        if r["customer_id"] is None or r["timestamp"] is None:
            assert (r["cumulative_count"], r["rolling_7d_count"], r["prev_timestamp"]) == (1, 1, None)


def test_amounts_below_a_cent_count(frame):
    rows = frame([txn(1, 0, 0.004), txn(2, 1, 0.004), txn(3, 2, 0.125)])
    for how in PLANS.values():
        last = by_id(with_history(rows, **how))["T00000003"]
        assert (last["rolling_7d_amount"], last["cumulative_amount"]) == (0.133, 0.133)


def test_split_plan_is_short_and_scans_parts_once(spark, sf_dir):
    from tidewatch.sources.adapters import txn_events

    df = with_history(txn_events(spark, sf_dir), split=True, scale=Scale(busy_rows=20))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") <= 6
    assert plan.count("FileScan parquet") <= 5


def test_many_rows_of_one_instant_are_cut_by_id(frame):
    rows = frame([txn(i * 250_000, 0, 1.0, "HOT") for i in range(400)])
    got = with_history(rows, split=True, scale=ALL_SPLIT).select("cumulative_count", "rolling_7d_count").collect()
    assert sorted(r[0] for r in got) == list(range(1, 401))
    assert {r[1] for r in got} == {400}


def test_small_inputs_are_not_split_and_unknown_sizes_are(spark, sf_dir, frame):
    from tidewatch.sources.adapters import txn_events

    def text(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "LeftAnti" not in text(with_history(txn_events(spark, sf_dir)))
    large = Scale(small_input_bytes=1, busy_rows=0)
    assert "LeftAnti" in text(with_history(txn_events(spark, sf_dir), scale=large))
    # nobody is busy: the plan for whole customers, without a second branch
    assert "LeftAnti" not in text(with_history(txn_events(spark, sf_dir), scale=Scale(small_input_bytes=1)))


def test_prefix_scan_levels_agree_with_one_window(spark):
    rows = spark.range(500).selectExpr(
        "id % 3 as k", "cast(id * 37 % 500 as int) as pos", "cast(id * 11 % 97 as long) as v"
    )
    levelled = rows.withColumns({"a": F.expr("pos div 100"), "b": F.expr("pos div 10")})
    got = prefix_scan(levelled, ["k"], [["a"], ["b"], ["pos"]], {"v": "sum"}, overall=True)
    want = rows.selectExpr(
        "k",
        "pos",
        "coalesce(sum(v) over (partition by k order by pos rows between unbounded preceding and 1 preceding), 0) as w",
        "sum(v) over (partition by k) as t",
    )
    pairs = got.join(want, ["k", "pos"])
    assert pairs.count() == 500
    assert pairs.where("before_v <> w or all_v <> t").count() == 0


def test_scored_plan_has_one_exchange_one_sort_and_no_python(spark, sf_dir):
    from tidewatch.sources.adapters import txn_events

    from tidewatch.operators.quality import accepted

    txn = accepted(txn_events(spark, sf_dir))
    plan = score_transactions(txn, split=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_key") == 1
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1
    assert "Python" not in plan
    assert "PushedFilters: [IsNotNull(" in plan
    assert "props" not in plan.split("ReadSchema")[1]


def test_unused_windows_are_dropped(spark, sf_dir):
    from tidewatch.plans.detection import high_velocity
    from tidewatch.sources.adapters import txn_events

    plan = high_velocity(txn_events(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    assert "lag(" not in plan


def test_longer_lookback_is_a_parameter(frame):
    rows = frame([txn(1), txn(2, 2 * WEEK)])
    rules = replace(Rules(), lookback_seconds=2 * WEEK)
    assert by_id(with_history(rows, rules, split=False))["T00000002"]["rolling_7d_count"] == 2
