from .scalar import (
    coalesce_days, date_fields, date_part, day_of_month, format_day, is_saturday, pad_student_id, parse_day,
    prev_day, risk_prob, round_display, term_kind, threshold_pred, week_sunday_zero,
)

__all__ = [
    "coalesce_days", "date_fields", "date_part", "day_of_month", "format_day", "is_saturday", "pad_student_id",
    "parse_day", "prev_day", "risk_prob", "round_display", "term_kind", "threshold_pred", "week_sunday_zero",
]
