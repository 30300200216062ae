"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from leadlens.functions.codes import (attendance_code, booking_stage, booking_status,
                                      channel_code, channel_type, client_id, full_name,
                                      kpi_status, severity, status_code)
from leadlens.functions.dates import business_date, ceil_day, hours_between, week_start
from leadlens.functions.phone import normalize_phone, phone_digits, phone_valid
from leadlens.functions.ratios import pct, romi, safe_div

__all__ = [
    "attendance_code", "booking_stage", "booking_status", "business_date", "ceil_day",
    "channel_code", "channel_type", "client_id", "full_name", "hours_between",
    "kpi_status", "normalize_phone", "pct", "phone_digits", "phone_valid", "romi",
    "safe_div", "severity", "status_code", "week_start",
]
