"""Short ways to write events and clicks in tests."""

import hashlib
from datetime import datetime
from decimal import Decimal

from cohortrail.schemas import APP_EVENT, CLICK, WEB_EVENT


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def at(text):
    """`'2 10:00'` is January 2, 10 o'clock."""
    day, clock = text.split()
    return datetime.fromisoformat(f"2024-01-{int(day):02d} {clock}")


_ids = iter(range(10**9))


def event(kind, device, when, os=1, app="49", amount=None, event_id=None, **ids):
    row = dict.fromkeys(APP_EVENT.fieldNames())
    own = {"oaid": md5(device)} if os == 1 else {"uuid": md5(device)}
    row |= {"app_id": app, "device_id": md5(device), "os": os, "kind": kind, "ts": at(when),
            "event_id": next(_ids) if event_id is None else event_id,
            "amount": None if amount is None else Decimal(amount), **own, **ids}
    return row


def click(plan, when, os=1, click_id=None, channel="1", **keys):
    row = dict.fromkeys(CLICK.fieldNames())
    return row | {"os": os, "click_id": next(_ids) if click_id is None else click_id, "click_ts": at(when),
                  "plan_id": plan, "channel_id": channel, **keys}


def web(clickid, creative, when, app="49", plan="7", event_id=None, **more):
    row = dict.fromkeys(WEB_EVENT.fieldNames(), "1")
    return row | {"media_clickid": clickid, "media_creativeid": creative, "app_id": app, "plan_id": plan,
                  "ts": at(when), "event_id": next(_ids) if event_id is None else event_id, **more}


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in rows], schema)


def events_frame(spark, rows):
    return frame(spark, rows, APP_EVENT)


def clicks_frame(spark, rows=()):
    return frame(spark, rows, CLICK)


def web_frame(spark, rows):
    return frame(spark, rows, WEB_EVENT)
