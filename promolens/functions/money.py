"""Exact money arithmetic on 64-bit integers, as SQL expressions.

An amount is a whole number of micro-euros, the resolution of ``decimal(18,6)``. A sum is kept
as two 64-bit sums, of the amount's upper and lower bits. That adds at machine speed in
generated code, merges over any number of groupings, and cannot overflow for totals below
9e18 euros or 8e12 rows; a wide decimal sum costs an object per addition instead.
"""

from __future__ import annotations

MICRO = "0.000001"
LOW_BITS = 20
LOW_MASK = (1 << LOW_BITS) - 1
_TOO_LARGE = "CAST(raise_error('amount does not fit decimal(18,6)') AS BIGINT)"


def micros(amount: str) -> str:
    """A double amount in euros as micro-euros, rounded half up; fails when out of range.

    For sources that are doubles themselves: above about 9e9 euros a double no longer holds
    micro-euros, so their amounts are only as exact as they came.
    """
    scaled = f"floor(abs({amount}) * 1e6D + 0.5D)"
    return (
        f"CASE WHEN abs({amount}) < 1e12D THEN if({amount} < 0, -{scaled}, {scaled})"
        f" WHEN {amount} IS NOT NULL THEN {_TOO_LARGE} END"
    )


def quotient_micros(amount: str, scale: int, rate: str, rate_scale: int) -> str:
    """amount / rate in micro-euros for decimals of these scales: exact, rounded half up.

    Both become whole numbers first, so nothing is rounded before the one division.
    """
    shift = 6 + rate_scale - scale
    over = f"CAST(abs({amount}) * {10**scale} AS DECIMAL(38,0)) * {10 ** max(shift, 0)}"
    under = f"CAST(abs({rate}) * {10**rate_scale} AS DECIMAL(38,0)) * {10 ** max(-shift, 0)}"
    over, under = (f"CAST({x} AS DECIMAL(38,0))" for x in (over, under))
    rounded = f"CAST(((2 * {over} + {under}) div (2 * {under})) AS BIGINT)"
    signed = f"if(({amount} < 0) <> ({rate} < 0), -{rounded}, {rounded})"
    fits = f"abs({amount}) < CAST(1000000000000 AS DECIMAL(20,0)) * abs({rate})"
    return (
        f"CASE WHEN {amount} IS NULL OR {rate} IS NULL OR {rate} = 0 THEN NULL"
        f" WHEN {fits} THEN {signed} ELSE {_TOO_LARGE} END"
    )


def as_money(value: str) -> str:
    """Micro-euros as decimal(18,6)."""
    return f"CAST(CAST({value} AS DECIMAL(18,0)) * {MICRO} AS DECIMAL(18,6))"


def divide_half_up(value: str, n: str) -> str:
    """64-bit division rounded half up (away from zero), for n > 0 and |value| < 2**61."""
    rounded = f"((2 * abs({value}) + {n}) div (2 * {n}))"
    return f"if({value} < 0, -{rounded}, {rounded})"


def start_sum(value: str, name: str, weight: str = "1L") -> list[str]:
    """Begin a sum of micro-euro amounts, each taken ``weight`` times."""
    return [
        f"sum(shiftright({value}, {LOW_BITS}) * {weight}) AS {name}_hi",
        f"sum((({value}) & {LOW_MASK}L) * {weight}) AS {name}_lo",
    ]


def merge_sum(name: str, new_name: str | None = None, where: str | None = None) -> list[str]:
    """Carry a started sum into the next grouping, for the rows of ``where`` only."""
    kept = f" FILTER (WHERE {where})" if where else ""
    return [f"sum({name}_{part}){kept} AS {new_name or name}_{part}" for part in ("hi", "lo")]


def _whole(name: str) -> str:
    return (
        f"(CAST({name}_hi AS DECIMAL(20,0)) * {1 << LOW_BITS} + CAST({name}_lo AS DECIMAL(20,0)))"
    )


def total(name: str) -> str:
    """The finished sum in euros; NULL if nothing was added."""
    return f"CAST({_whole(name)} * {MICRO} AS DECIMAL(38,6))"


def is_positive(name: str) -> str:
    """Whether a started sum exceeds 0: its lower part is carried into the upper one first."""
    upper = f"({name}_hi + shiftright({name}_lo, {LOW_BITS}))"
    return f"({upper} > 0 OR ({upper} = 0 AND ({name}_lo & {LOW_MASK}L) > 0))"


def mean_micros(name: str, n: str) -> str:
    """Mean amount in micro-euros, rounded half up; NULL if nothing was counted.

    The upper part is divided first and its remainder joins the lower part, so all of it stays
    within 64 bits for any amounts and up to 2**42 rows.
    """
    over = f"pmod({name}_hi, {n})"
    rest = f"({over} * {1 << LOW_BITS}L + {name}_lo)"
    whole = f"((({name}_hi - {over}) div {n}) * {1 << LOW_BITS}L + {rest} div {n})"
    left = f"({rest} % {n})"
    up = f"(2 * {left} > {n} OR (2 * {left} = {n} AND {whole} >= 0))"
    return f"CASE WHEN {n} > 0 THEN {whole} + if({up}, 1L, 0L) END"


def share_half_up(part: str, of: str, unit: int) -> str:
    """part / of in whole ``unit``-ths, rounded half up (away from zero); NULL if of is 0."""
    whole = f"abs(CAST({of} AS DECIMAL(20,0)))"
    over = f"CAST(2 * abs(CAST({part} AS DECIMAL(20,0))) * {unit} + {whole} AS DECIMAL(38,0))"
    rounded = f"CAST({over} div CAST(2 * {whole} AS DECIMAL(38,0)) AS BIGINT)"
    signed = f"if(({part} < 0) <> ({of} < 0), -{rounded}, {rounded})"
    return f"CASE WHEN {of} <> 0 THEN {signed} END"
