"""Column-name normalisation (snake case)."""

from __future__ import annotations

# The substitution steps of the naming rule, applied in this
# order after stripping and lower-casing. Each step is one left-to-right,
# non-overlapping replace, so "a - b" becomes "a__b" and "Margin %" becomes
# "margin__pct".
NAME_STEPS = ((" ", "_"), ("-", "_"), ("__", "_"), ("%", "_pct"))


def snake_case(name: str) -> str:
    out = name.strip().lower()
    for old, new in NAME_STEPS:
        out = out.replace(old, new)
    return out
