from __future__ import annotations

import datetime as dt

from change_log import LOG_SCHEMA, literal_rows, ts

from tidemark.operators import merge_close_and_insert, merge_current

OPEN = dt.datetime(9999, 12, 31)
CUR_SCHEMA = "id long, name string, email string, action string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def _current(spark):
    return spark.createDataFrame([
        (1, "a", "a@x", "INSERT", ts("2024-01-01 00:00:00"), OPEN),   # will be updated
        (2, "b", "b@x", "INSERT", ts("2024-01-01 00:00:00"), OPEN),   # will be deleted
        (3, "c", "c@x", "INSERT", ts("2024-01-01 00:00:00"), OPEN),   # matched insert -> unchanged
        (4, "d", "d@x", "UPDATE", ts("2024-01-01 00:00:00"), OPEN),   # no change
        (5, "e", "e@x", "INSERT", ts("2023-12-01 00:00:00"), ts("2023-12-05 00:00:00")),  # closed row
    ], CUR_SCHEMA)


def _changes(spark):
    return spark.createDataFrame(literal_rows([
        (1, 1, "UPDATE", "2024-01-02 09:00:00"),
        (2, 1, "UPDATE", "2024-01-02 10:00:00"),   # two changes for key 1: the later wins (MERGE needs one)
        (3, 2, "DELETE", "2024-01-02 10:00:00"),
        (4, 3, "INSERT", "2024-01-02 10:00:00"),
        (5, 6, "INSERT", "2024-01-02 10:00:00"),   # unknown key
        (6, 7, "DELETE", "2024-01-02 10:00:00"),   # unknown key, delete: inserted as-is by MERGE semantics
    ]), LOG_SCHEMA)


def test_merge_current(spark):
    got = sorted(tuple(r) for r in merge_current(_current(spark), _changes(spark)).collect())
    t2 = ts("2024-01-02 10:00:00")
    assert got == [
        (1, "name2", "mail2@x", "UPDATE", t2, OPEN),
        (2, "b", "b@x", "DELETE", ts("2024-01-01 00:00:00"), t2),
        (3, "c", "c@x", "INSERT", ts("2024-01-01 00:00:00"), OPEN),
        (4, "d", "d@x", "UPDATE", ts("2024-01-01 00:00:00"), OPEN),
        (5, "e", "e@x", "INSERT", ts("2023-12-01 00:00:00"), ts("2023-12-05 00:00:00")),
        (6, "name5", "mail5@x", "INSERT", t2, OPEN),
        (7, "name6", "mail6@x", "DELETE", t2, OPEN),
    ]


def test_merge_close_and_insert(spark):
    out = merge_close_and_insert(_current(spark), _changes(spark), as_of="2024-01-02")
    got = sorted(tuple(r) for r in out.collect())
    t0, t2, d = ts("2024-01-01 00:00:00"), ts("2024-01-02 10:00:00"), dt.date(2024, 1, 2)
    assert got == [
        (1, "a", "a@x", "INSERT", t0, t2, d),              # closed by the update
        (1, "name2", "mail2@x", "UPDATE", t2, OPEN, d),     # new version
        (2, "b", "b@x", "DELETE", t0, t2, d),               # closed by the delete
        (3, "c", "c@x", "INSERT", t0, OPEN, d),             # insert of a live key: stays open ...
        (3, "name4", "mail4@x", "INSERT", t2, OPEN, d),     # ... and a second open row is added
        (4, "d", "d@x", "UPDATE", t0, OPEN, d),
        (5, "e", "e@x", "INSERT", ts("2023-12-01 00:00:00"), ts("2023-12-05 00:00:00"), d),
        (6, "name5", "mail5@x", "INSERT", t2, OPEN, d),
    ]


def test_merge_accepts_lower_case_actions(spark):
    changes = _changes(spark).selectExpr("seq", "id", "name", "email", "lower(action) AS action",
                                         "updated_timestamp", "partition_date")
    got = {r.id: r.action for r in merge_current(_current(spark), changes).collect()}
    assert got[1] == "update" and got[2] == "delete" and got[3] == "INSERT"
