"""Display text built after a limit, so it only touches the rows shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formlake import constants as K


def _fixed(value: Column, pattern: str) -> Column:
    """``value`` under a number pattern, rounded on the exact double, ties to even
    (``format_string`` would round ties up)."""
    return F.call_function("format_number", value, F.lit(pattern))


def dip_text(dip: str | Column = "dip_from_52w_high") -> Column:
    """0.3125 -> '31.2%' (x100, half-even to one decimal, percent sign)."""
    c = F.col(dip) if isinstance(dip, str) else dip
    return F.concat(F.bround(c * 100, 1).cast("string"), F.lit("%"))


def money0(value: Column) -> Column:
    """Thousands separators, no decimals: 1234.6 -> '1,235'."""
    return F.format_number(value, 0)


def marker_label(side: str, owner: Column, value: Column) -> Column:
    """The marker text of a trade; null without an owner or a value."""
    text = F.format_string(K.BUY_LABEL if side == "buy" else K.SELL_LABEL, owner, money0(value))
    return F.when(owner.isNotNull() & value.isNotNull(), text)


def sell_reason(title: Column, total: Column, cluster_size: Column) -> Column:
    """Comma-joined reasons; '' when none apply (concat_ws skips nulls)."""
    upper_title = F.upper(title)
    c_suite = None
    for word in K.REASON_C_SUITE_SUBSTRINGS:
        cond = upper_title.contains(word)
        c_suite = cond if c_suite is None else (c_suite | cond)
    return F.concat_ws(
        ", ",
        F.when(c_suite, F.lit(K.REASON_C_SUITE)),
        F.when(total > K.WHALE_DUMP_ABOVE, F.lit(K.REASON_WHALE)),
        F.when(cluster_size > 1, F.format_string(K.REASON_CLUSTER, cluster_size)),
    )


def dollars0(value: Column) -> Column:
    """'$1,235' (display format of totals)."""
    return F.concat(F.lit("$"), F.format_number(value, 0))


def dollars2(value: Column) -> Column:
    """'$12.35' (display format of prices; no thousands separator)."""
    return F.concat(F.lit("$"), _fixed(value, "0.00"))


def fixed1(value: Column) -> Column:
    """'12.3' (display format of ratios)."""
    return _fixed(value, "0.0")
