"""Column expressions: all JVM-side built-ins, safe inside whole-stage codegen."""

from formlake.functions.display import dip_text, marker_label, sell_reason
from formlake.functions.parsing import flag_is_true, strict_double, text_or_default
from formlake.functions.scores import (
    c_suite_title,
    elite_fundamental_scores,
    elite_value_band,
    score_cluster,
    score_role,
    score_value_high,
    score_value_mid,
)

__all__ = [
    "c_suite_title",
    "dip_text",
    "elite_fundamental_scores",
    "elite_value_band",
    "flag_is_true",
    "marker_label",
    "score_cluster",
    "score_role",
    "score_value_high",
    "score_value_mid",
    "sell_reason",
    "strict_double",
    "text_or_default",
]
