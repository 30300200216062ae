"""Code mappings written as column expressions over the fixed values in config."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlens import config as C


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _map_expr(mapping: dict) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def status_code(status_id: Column | str) -> Column:
    """CRM status id -> five coarse codes (N-03); unknown ids keep their text."""
    s = _c(status_id)
    return (F.when(s.isin(*C.STATUS_NEW), "NEW")
            .when(s.isin(*(C.STATUS_NEGOTIATION + C.STATUS_NO_ANSWER)), "IN_WORK")
            .when(s.isin(C.STATUS_APPOINTMENT, C.STATUS_NO_SHOW), "APPOINTMENT")
            .when(s.isin(C.STATUS_NOT_PURCHASED, C.STATUS_DEPOSIT, C.STATUS_SUCCESS,
                         C.STATUS_SINGLE_VISITS), "COMPLETED")
            .when(s.isin(C.STATUS_CLOSED_LOST, C.STATUS_NO_RENEWAL), "REFUSAL")
            .otherwise(s.cast("string")))


def booking_status(col: Column | str) -> Column:
    """Any source spelling -> {waiting, confirmed, visited, no_show, canceled} (N-05/N-06)."""
    return F.element_at(_map_expr(C.BOOKING_STATUS_SPELLINGS), F.lower(F.trim(_c(col))))


def booking_stage(col: Column | str) -> Column:
    """Booking status -> funnel stage: visited->completed, no-show, canceled, else NULL."""
    st = booking_status(col)
    return (F.when(st == "visited", "completed").when(st == "no_show", "no_show")
            .when(st == "canceled", "canceled"))


def attendance_code(col: Column | str) -> Column:
    """Attendance -1/0/1/2 -> no_show/waiting/visited/confirmed."""
    return F.element_at(_map_expr(C.ATTENDANCE_CODES), _c(col).cast("int"))


def channel_code(col: Column | str) -> Column:
    """Sheet label or utm value -> utm code; blank -> NULL."""
    v = F.lower(F.trim(_c(col)))
    return F.when(F.length(v) > 0, F.coalesce(F.element_at(_map_expr(C.CHANNEL_LABELS), v), v))


def channel_type(col: Column | str) -> Column:
    """utm code -> organic/paid/social/referral, default other."""
    return F.coalesce(F.element_at(_map_expr(C.CHANNEL_TYPES), _c(col)), F.lit("other"))


def client_id(studio: Column | str, phone: Column | str) -> Column:
    """Deterministic client key: md5 of studio and normalised phone."""
    return F.md5(F.concat_ws(":", _c(studio), _c(phone)))


def full_name(first: Column | str, last: Column | str) -> Column:
    """'first last' with blanks dropped; NULL when both are blank (N-17)."""
    f = F.nullif(F.trim(_c(first)), F.lit(""))
    la = F.nullif(F.trim(_c(last)), F.lit(""))
    return F.nullif(F.concat_ws(" ", f, la), F.lit(""))


def severity(pct_col: Column | str) -> Column:
    """Mismatch band: <5 INFO, 5..10 WARNING, >10 CRITICAL (R-04)."""
    p = _c(pct_col)
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p < C.SEVERITY_INFO_BELOW, "INFO")
            .when(p <= C.SEVERITY_CRITICAL_ABOVE, "WARNING")
            .otherwise("CRITICAL"))


def kpi_status(value: Column | str, low: float, high: float) -> Column:
    """below / within / above a norm range (M-21)."""
    v = _c(value)
    return (F.when(v.isNull(), F.lit(None).cast("string")).when(v < low, "below")
            .when(v > high, "above").otherwise("within"))
