"""Exactly rounded means.

``round(avg(x)::numeric, 2)`` over doubles depends on summation order at
half-cent ties, so two engines (or two runs with different partitioning) can
disagree. Here every input is taken as the decimal number its shortest text
form shows (16 decimals) and kept as two sums: of the whole parts and of the
fractions (both rounded down). Either sum has room for 1e16 rows, so neither can overflow, and the
mean is rounded half away from zero once, from quotient and remainder. The result does not
depend on partitioning, and the rule is the same for every number of rows and
every finite value below 1e20 in size.

A group that holds NaN, an infinity or a larger value has no such decimal; its mean is that of
the doubles. NULL inputs are ignored; an all-NULL group gives NULL.

The two sums and the count are also the state of incremental rollups
(:func:`sum_columns`): they add and subtract without loss.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import quote

EXACT_BELOW = "1e20D"


def _decimal(c: str) -> str:
    return (f"CASE WHEN isnan({c}) OR abs({c}) >= {EXACT_BELOW} THEN NULL "
            f"ELSE CAST({c} AS DECIMAL(36,16)) END")


def signed(value: str, sign: str | None) -> str:
    return f"CASE WHEN {quote(sign)} < 0 THEN -{value} ELSE {value} END" if sign else value


def sum_columns(name: str, sign: str | None = None) -> dict[str, str]:
    """Aggregate SQL of the mean's state: whole, part, n, and the values outside the rule.

    ``sign`` names a column of 1 and -1 for rows that are added and taken back.
    """
    c = quote(name)
    d = _decimal(c)
    one = quote(sign) if sign else "1"
    # Types are kept narrow enough for every step: Spark cuts the scale of wider results.
    floor = f"CAST(floor({d}) AS DECIMAL(20,0))"
    whole = signed(f"CAST({floor} AS DECIMAL(28,0))", sign)
    part = signed(f"CAST(({d}) - {floor} AS DECIMAL(28,16))", sign)
    outside = f"{c} IS NOT NULL AND ({d}) IS NULL"
    return {
        "whole": f"CAST(coalesce(sum({whole}), 0) AS DECIMAL(38,0))",
        "part": f"CAST(coalesce(sum({part}), 0) AS DECIMAL(38,16))",
        "n": f"coalesce(sum(CASE WHEN {c} IS NOT NULL THEN {one} ELSE 0 END), 0)",
        "odd": f"coalesce(sum(CASE WHEN {outside} THEN {one} ELSE 0 END), 0)",
    }


def _let(name: str, fields: dict[str, str], body: str) -> str:
    """SQL that evaluates ``fields`` once and names them for ``body`` (``name.field``)."""
    pairs = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    return f"element_at(transform(array(named_struct({pairs})), {name} -> {body}), 1)"


def mean_of_sums_sql(whole: str, part: str, n: str, scale: int = 2) -> str:
    """SQL of the mean of the two sums over ``n`` values, rounded half away from zero."""
    if not 0 <= scale <= 2:
        raise ValueError("scale must be 0, 1 or 2")
    unit = 10 ** scale
    step = ("1", "0.1", "0.01")[scale]
    # total = w + f with 0 <= f < 1, then |total| = a + b likewise
    total = {"w": f"CAST({whole} + floor({part}) AS DECIMAL(38,0))",
             "f": f"CAST({part} % CAST(1 AS DECIMAL(1,0)) AS DECIMAL(17,16))",
             "n": f"CAST(nullif({n}, 0) AS DECIMAL(17,0))"}
    size = {"a": "CAST(CASE WHEN _t.w < 0 THEN -_t.w - CAST(_t.f > 0 AS INT) ELSE _t.w END "
                 "AS DECIMAL(38,0))",
            "b": "CAST(CASE WHEN _t.w < 0 AND _t.f > 0 THEN 1 - _t.f ELSE _t.f END "
                 "AS DECIMAL(17,16))"}
    over = {"r": "CAST(_s.a % _t.n AS DECIMAL(17,0))"}
    fine = {"q": "CAST(CAST(_s.a - _o.r AS DECIMAL(38,0)) / _t.n AS DECIMAL(28,0))",
            "m": f"CAST((_o.r + _s.b) * {unit} AS DECIMAL(38,16))"}
    last = {"l": "CAST(_m.m % _t.n AS DECIMAL(36,16))"}
    units = (f"CAST(_m.q * {unit} + CAST(CAST(_m.m - _l.l AS DECIMAL(38,16)) / _t.n AS DECIMAL(5,0)) "
             "+ CAST(_l.l * 2 >= _t.n AS INT) AS DECIMAL(34,0))")
    value = f"CAST(CAST({units} * CAST({step} AS DECIMAL(3,2)) AS DECIMAL(37,2)) AS DOUBLE)"
    whole_sign = "CASE WHEN _t.w < 0 THEN -1 ELSE 1 END"
    return _let("_t", total, _let("_s", size, _let("_o", over, _let("_m", fine,
                                                                    _let("_l", last, f"{whole_sign} * {value}")))))


def rounded_mean_sql(name: str, scale: int = 2) -> str:
    """Spark SQL aggregate expression text for the exact rounded mean."""
    s = sum_columns(name)
    exact = mean_of_sums_sql(s["whole"], s["part"], s["n"], scale)
    return f"CASE WHEN {s['odd']} > 0 THEN round(avg({quote(name)}), {scale}) ELSE {exact} END"


def rounded_mean(name: str, scale: int = 2) -> Column:
    """Aggregate column: mean of ``name`` rounded half away from zero, exactly."""
    return F.expr(rounded_mean_sql(name, scale)).cast("double")
