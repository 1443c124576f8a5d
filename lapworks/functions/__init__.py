"""Column-expression helpers: everything here returns a ``Column`` that
stays inside whole-stage codegen (no Python UDFs)."""

from lapworks.functions.columns import (  # noqa: F401
    exact_avg,
    null_if_sentinel,
    nan_to_null,
    parse_timestamp,
    round_to,
    safe_cast,
    trimmed,
    upper_trimmed,
)
from lapworks.functions.rules import Rule, first_failing_rule, passes_all  # noqa: F401
