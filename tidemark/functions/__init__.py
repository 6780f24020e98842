"""Column-expression helpers shared by every operator (all JVM-side built-ins, no UDFs)."""

from tidemark.functions.temporal import (  # noqa: F401
    OPEN_END_TEXT,
    day_window_filter,
    millis_to_ntz,
    open_end,
    resolve_as_of,
)
from tidemark.functions.vocab import (  # noqa: F401
    DELETE,
    INSERT,
    LIVE_ACTIONS,
    UPDATE,
    action_from_op,
    op_from_action,
)
