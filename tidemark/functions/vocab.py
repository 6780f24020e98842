"""Change-action vocabulary.

Fixed values (must equal the source system's vocabulary for results to match):
  actions written by the ingestion jobs:    INSERT, UPDATE, DELETE
  change-envelope operation codes:          c (create), r (snapshot read), u (update), d (delete), t (truncate of the table)
  legacy lower-case actions (gen-1 tables): insert, update, delete
  mapping used here: c -> INSERT, r -> INSERT, u -> UPDATE, d -> DELETE
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INSERT = "INSERT"
UPDATE = "UPDATE"
DELETE = "DELETE"
LIVE_ACTIONS = (INSERT, UPDATE)
TRUNCATE_OP = "t"

OP_TO_ACTION = {"c": INSERT, "r": INSERT, "u": UPDATE, "d": DELETE}
ACTION_TO_OP = {INSERT: "c", UPDATE: "u", DELETE: "d"}


def action_from_op(op: Column) -> Column:
    """Envelope operation code -> action; unknown codes (e.g. 't' truncate) give null."""
    expr = None
    for code, action in OP_TO_ACTION.items():
        expr = (F.when(op == code, F.lit(action)) if expr is None
                else expr.when(op == code, F.lit(action)))
    return expr


def op_from_action(action: Column) -> Column:
    """Action -> envelope operation code (used to build envelopes from a change log)."""
    u = F.upper(action)
    return (F.when(u == INSERT, F.lit("c"))
            .when(u == UPDATE, F.lit("u"))
            .when(u == DELETE, F.lit("d")))
