"""Declarative job specs (extract -> transform -> load) and multi-stage runs."""

from tidemark.plans.bronze import raw_to_bronze  # noqa: F401
from tidemark.plans.spec import (  # noqa: F401
    STEPS,
    apply_steps,
    extract,
    load,
    read_spec_file,
    run_spec,
    run_spec_file,
    run_stages,
    transform,
)
