"""A record-at-a-time model of the rules, in plain Python: the second, independent check of the operators."""

from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

LEVELS = {1: ["imei", "oaid", "androidid", "external_ip"], 2: ["external_ip", "idfa"]}
IGNORED = {None, "", "9f89c84a559f573636a47ff8daed0d33", "d41d8cd98f00b204e9800998ecf8427e",
           "00000000-0000-0000-0000-000000000000"}


def credit(event, clicks, lookback=None):
    for level in LEVELS[event["os"]]:
        key = event[level]
        if key in IGNORED:
            continue
        hits = [
            c for c in clicks
            if c["os"] == event["os"] and c[level] == key and c["click_ts"] <= event["ts"]
            and (lookback is None or c["click_ts"] >= event["ts"] - timedelta(days=lookback))
        ]
        if hits:
            best = min(hits, key=lambda c: (c["click_ts"], c["click_id"]))
            return best["plan_id"], best["channel_id"]
    return "0", "0"


def run(events, clicks, lookback=None):
    """`events` in processing order. Returns daily, retention, pay tables, rejected ids and final state."""
    state = {}
    daily = defaultdict(lambda: defaultdict(int))
    kept = defaultdict(int)
    pay = defaultdict(lambda: defaultdict(int))
    rejects = []
    for e in events:
        key, today = (e["app_id"], e["device_id"]), e["ts"].date()
        s = state.get(key)
        if e["kind"] == "launch":
            late = s is not None and e["ts"] < s["last"]
            if s is None:
                plan, channel = credit(e, clicks, lookback)
                s = state[key] = {"plan": plan, "channel": channel, "active": e["ts"], "last": None, "reg": False,
                                  "first_pay": None, "pay_days": set()}
            row = daily[(e["app_id"], s["plan"], today)]
            row["launch_count"] += 1
            if not late:
                if s["last"] is None:
                    row["active_count"] += 1
                if s["last"] is None or s["last"].date() < today:
                    row["vibrant_count"] += 1
                    age = (today - s["active"].date()).days + 1
                    if age > 1:
                        kept[(e["app_id"], s["plan"], s["active"].date(), age)] += 1
                s["last"] = e["ts"]
            continue
        if s is None or s["active"] > e["ts"]:
            rejects.append(e["event_id"])
            continue
        row = daily[(e["app_id"], s["plan"], today)]
        if e["kind"] == "reg":
            row["reg_count"] += 1
            row["onlyreg_count"] += not s["reg"]
            s["reg"] = True
            continue
        amount = e["amount"]
        row["pay_count"] += 1
        row["pay_amount"] += amount
        cohort = pay[(e["app_id"], s["plan"], s["active"].date(), (today - s["active"].date()).days + 1)]
        cohort["pay_count"] += 1
        cohort["pay_amount"] += amount
        if s["first_pay"] is None:
            cohort["pay_new_devices"] += 1
            cohort["pay_new_amount"] += amount
            s["first_pay"] = e["ts"]
        if today not in s["pay_days"]:
            cohort["pay_total_devices"] += 1
        if s["active"].date() == today:
            cohort["pay_active_count"] += 1
            cohort["pay_active_amount"] += amount
        s["pay_days"].add(today)
    return {"daily": daily, "retention": kept, "pay": pay, "rejects": sorted(rejects), "state": state}


def table(df, keys, measures):
    """Statistics DataFrame as `{key: {measure: value}}`, zero measures left out."""
    out = {}
    for r in df.collect():
        out[tuple(r[k] for k in keys)] = {m: r[m] for m in measures if r[m] != 0}
    return out


def trimmed(rows):
    return {k: {m: Decimal(v) if isinstance(v, Decimal) else int(v) for m, v in row.items() if v != 0} for k, row in rows.items()}
