from __future__ import annotations

import datetime as dt
import json

from tidemark.operators import normalize_after_image, normalize_envelope

T0 = 1704103200000  # 2024-01-01 10:00:00 UTC in epoch ms


def _msg(op, before=None, after=None, ts_ms=T0, wrapped=True):
    body = {"before": before, "after": after, "op": op, "source": {"ts_ms": ts_ms}}
    return json.dumps({"payload": body} if wrapped else body)


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_normalize_envelope_cases(spark):
    row = {"id": "1", "name": "n", "email": "e"}
    values = [
        _msg("c", after=row),
        _msg("r", after=row, wrapped=False),
        _msg("u", before=row, after={"id": "1", "name": "n2", "email": "e2"}),
        _msg("d", before=row, wrapped=False),
        _msg("t"),
        None,
        "{not json",
        _msg("u", after=row, ts_ms=T0 - 86400000 * 30),  # late change: its own old partition
    ]
    good, bad = normalize_envelope(_frame(spark, values))
    g = sorted((r.operation, r.action, r.name, r.updated_timestamp, r.partition_date) for r in good.collect())
    t = dt.datetime(2024, 1, 1, 10)
    assert g == [
        ("c", "INSERT", "n", t, t.date()),
        ("d", "DELETE", "n", t, t.date()),            # delete image comes from `before`
        ("r", "INSERT", "n", t, t.date()),
        ("u", "UPDATE", "n", t - dt.timedelta(days=30), dt.date(2023, 12, 2)),
        ("u", "UPDATE", "n2", t, t.date()),
    ]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["malformed envelope", "null message", "unsupported op"]


def test_normalize_envelope_millisecond_precision(spark):
    good, _ = normalize_envelope(_frame(spark, [_msg("c", after={"id": "9"}, ts_ms=T0 + 123)]))
    assert good.collect()[0].updated_timestamp == dt.datetime(2024, 1, 1, 10, 0, 0, 123000)


def test_normalize_after_image_gives_nulls_for_deletes(spark):
    row = {"id": "1", "name": "n", "email": "e", "update_timestamp": "2024-01-01 10:00:00"}
    values = [_msg("c", after=row), _msg("d", before=row),
              _msg("u", after={**row, "update_timestamp": "garbage"})]
    got = sorted((r.op, r.id, r.update_timestamp) for r in normalize_after_image(_frame(spark, values)).collect())
    assert got == [("c", "1", dt.datetime(2024, 1, 1, 10)), ("d", None, None), ("u", "1", None)]


def test_envelope_is_parsed_once(spark):
    good, _ = normalize_envelope(_frame(spark, [_msg("c", after={"id": "1"})]))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
