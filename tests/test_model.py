import pytest

from cohortrail.operators import stats, timeline
from cohortrail.sources import given_tables as given
from tests import model
from tests.conftest import DATA


def _rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def case(request, spark):
    sf_dir = f"{DATA}/{request.param}"
    events, clicks = given.app_events(spark, sf_dir), given.clicks(spark, sf_dir)
    ordered = sorted(_rows(events), key=lambda e: (e["ts"], e["event_id"]))
    return events, clicks, ordered, _rows(clicks)


# A hot limit of 20 rows sends nearly all devices and addresses down the paths for hot keys.
@pytest.mark.parametrize("hot_rows, few_keys", [(2_000_000, 200_000), (20, 0)])
def test_step_equals_record_model(case, hot_rows, few_keys):
    events, clicks, ordered, click_rows = case
    want = model.run(ordered, click_rows)
    step = timeline.step(events, clicks, hot_rows=hot_rows, few_keys=few_keys)
    facts = step.facts.persist()
    daily = model.table(stats.daily(facts), stats.DAILY.keys, [*stats.DAILY.counts, *stats.DAILY.money])
    assert daily == model.trimmed(want["daily"])
    kept = {tuple(r[k] for k in stats.RETENTION.keys): r["retention_count"] for r in stats.retention(facts).collect()}
    assert kept == dict(want["retention"])
    pay = stats.PAY_COHORT
    assert model.table(stats.pay_cohort(facts), pay.keys, [*pay.counts, *pay.money]) == model.trimmed(want["pay"])
    assert sorted(r["event_id"] for r in step.rejects.collect()) == want["rejects"]
    got = {(r["app_id"], r["device_id"]): r for r in step.state.collect()}
    assert set(got) == set(want["state"])
    for key, s in want["state"].items():
        r = got[key]
        assert (r["plan_id"], r["channel_id"], r["active_time"], r["last_launch_time"]) == (
            s["plan"], s["channel"], s["active"], s["last"])
        assert (r["registered"], r["first_pay_time"], r["last_pay_date"]) == (
            s["reg"], s["first_pay"], max(s["pay_days"], default=None))
    facts.unpersist()


def test_lookback_equals_record_model(case):
    events, clicks, ordered, click_rows = case
    want = model.run(ordered, click_rows, lookback=1)["state"]
    got = timeline.step(events, clicks, lookback_days=1).state.collect()
    assert {(r["app_id"], r["device_id"]): r["plan_id"] for r in got} == {k: s["plan"] for k, s in want.items()}
