"""Column expressions (pure Catalyst, codegen-friendly)."""

from cartwheel.functions.expr import (  # noqa: F401
    bool_key,
    is_missing,
    parse_bool,
    r6,
    safe_ratio,
    unpivot,
)
