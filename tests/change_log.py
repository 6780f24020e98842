"""The literal change log of the tests: schema, rows and time parsing."""

from __future__ import annotations

import datetime as dt

SF = "/root/testdata/sf0.001"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


LOG_SCHEMA = ("seq long, id long, name string, email string, action string, "
              "updated_timestamp timestamp_ntz, partition_date date")

# The literal scenario: insert -> update -> update -> delete -> re-insert, an untouched key, a delete and an
# update of unknown keys, a timestamp tie resolved by seq and a late arrival.
LITERAL = [
    (1, 1, "INSERT", "2024-01-01 10:00:00"),
    (2, 1, "UPDATE", "2024-01-02 10:00:00"),
    (3, 1, "UPDATE", "2024-01-02 11:00:00"),
    (4, 1, "DELETE", "2024-01-03 10:00:00"),
    (5, 1, "INSERT", "2024-01-04 10:00:00"),
    (6, 2, "INSERT", "2024-01-01 10:00:00"),
    (7, 3, "DELETE", "2024-01-02 10:00:00"),
    (8, 4, "UPDATE", "2024-01-02 10:00:00"),
    (9, 5, "INSERT", "2024-01-02 10:00:00"),
    (10, 5, "UPDATE", "2024-01-02 10:00:00"),
    (11, 2, "UPDATE", "2023-12-31 10:00:00"),
]


def literal_rows(rows=LITERAL):
    out = []
    for seq, key, action, when in rows:
        t = ts(when)
        out.append((seq, key, f"name{seq}", f"mail{seq}@x", action, t, t.date()))
    return out
