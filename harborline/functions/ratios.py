"""Guarded decimal ratios as SQL expressions."""

from __future__ import annotations

_OPERAND = "DECIMAL(22,2)"  # leaves 16 fractional digits for the quotient


def ratio(numerator: str, denominator: str, digits: int = 2, times: int = 1) -> str:
    """``round(times * numerator / denominator, digits)``, NULL when undefined.

    Decimal arithmetic end to end, so the result does not depend on the order
    in which partial sums arrive.
    """
    top = f"CAST({numerator} AS {_OPERAND})"
    if times != 1:
        top = f"CAST({times} * {top} AS {_OPERAND})"
    bottom = f"NULLIF(CAST({denominator} AS {_OPERAND}), 0)"
    return f"CAST(ROUND({top} / {bottom}, {digits}) AS DECIMAL(18,{digits}))"
