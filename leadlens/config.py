"""Fixed values and default thresholds.

Everything here is a small, constant table: it is turned into a DataFrame
with ``spark.createDataFrame`` and may be broadcast because its size is
fixed by this file, not by the data.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's business rules)
# ---------------------------------------------------------------------------

# Canonical 12-stage funnel: (stage_order, stage_code, CRM status ids, group).
FUNNEL_STAGES = [
    (1, "new_lead", [74087434, 74087430], "new"),
    (2, "negotiation", [74087586, 84866070], "active"),
    (3, "no_answer", [74087582, 84866066], "active"),
    (4, "visit_scheduled", [74087590], "active"),
    (5, "no_show", [74087594], "visited"),
    (6, "first_visit_complete", [], "visited"),
    (7, "not_purchased", [74087598], "visited"),
    (8, "deposit_paid", [84237074], "closed_won"),
    (9, "success", [142], "closed_won"),
    (10, "no_renewal", [83303646], "closed_lost"),
    (11, "renewed", [84237070], "closed_won"),
    (12, "closed_not_realized", [143], "closed_lost"),
]

# Five coarse status codes of the first normalisation step.
STATUS_CODES = ["NEW", "IN_WORK", "APPOINTMENT", "COMPLETED", "REFUSAL"]

# Event-level stage dimension: (stage_code, stage_name, stage_group, stage_order).
EVENT_STAGES = [
    ("new", "New lead", "new", 0),
    ("contacted", "Contact made", "active", 1),
    ("negotiation", "Negotiation", "active", 2),
    ("booking_made", "Booking made", "active", 3),
    ("visited", "Visited", "visited", 4),
    ("abonement_sold", "Subscription sold", "closed_won", 5),
    ("no_show", "No-show", "closed_lost", 99),
    ("canceled", "Canceled", "closed_lost", 99),
    ("lost", "Lost", "closed_lost", 99),
]

# Booking status -> funnel stage (confirmed / waiting have no stage).
BOOKING_STATUS_STAGE = {
    "visited": "completed",
    "not_visited": "no_show",
    "canceled": "canceled",
    "confirmed": None,
    "waiting": None,
}

# Attendance code of the booking system.
ATTENDANCE_CODES = {-1: "no_show", 0: "waiting", 1: "visited", 2: "confirmed"}

# Spellings of booking statuses met in the sources -> canonical status.
BOOKING_STATUS_SPELLINGS = {
    "visited": "visited",
    "came": "visited",
    "not_visited": "no_show",
    "no_show": "no_show",
    "canceled": "canceled",
    "cancelled": "canceled",
    "confirmed": "confirmed",
    "waiting": "waiting",
}

# CRM status ids used by single rules.
STATUS_APPOINTMENT = 74087590
STATUS_NO_SHOW = 74087594
STATUS_NOT_PURCHASED = 74087598
STATUS_DEPOSIT = 84237074
STATUS_SUCCESS = 142
STATUS_CLOSED_LOST = 143
STATUS_NO_RENEWAL = 83303646
STATUS_SINGLE_VISITS = 84237070
STATUS_NEGOTIATION = [74087586, 84866070]
STATUS_NO_ANSWER = [74087582, 84866066]
STATUS_NEW = [74087434, 74087430]
ADVANCED_STATUSES = [74087590, 74087594, 142]
ATTENDED_OK_STATUSES = [142, 84237074]
MAIN_PIPELINE_ID = 9226358

# Studio detection by priority.
STUDIO_BY_STATUS = {74087582: "studio_a", 74087586: "studio_a",
                    84866066: "studio_b", 84866070: "studio_b"}
STUDIO_BY_USER = {12112418: "studio_a", 12112458: "studio_b"}
STUDIO_BY_STAFF = {5111463: "studio_a", 3741329: "studio_a", 3745349: "studio_a",
                   3757001: "studio_a", 4964993: "studio_a", 3910523: "studio_a",
                   4181742: "studio_a"}
STUDIO_BY_NAME = [("люблино", "studio_b"), ("рязанский", "studio_a")]

# Ad-sheet channel labels -> utm code, and utm code -> traffic type.
CHANNEL_LABELS = {"вк": "vk", "рся": "yandex", "сайт": "site"}
CHANNEL_TYPES = {"yandex": "paid", "google": "paid", "vk": "social",
                 "instagram": "social", "telegram": "social", "site": "organic",
                 "referral": "referral"}

# Allowed stage-to-stage edges of the funnel diagram (12-code stages).
ALLOWED_EDGES = [
    ("new_lead", "negotiation"),
    ("new_lead", "no_answer"),
    ("new_lead", "closed_not_realized"),
    ("no_answer", "closed_not_realized"),
    ("no_answer", "negotiation"),
    ("negotiation", "visit_scheduled"),
    ("negotiation", "closed_not_realized"),
    ("visit_scheduled", "no_show"),
    ("visit_scheduled", "first_visit_complete"),
    ("no_show", "visit_scheduled"),
    ("no_show", "closed_not_realized"),
    ("first_visit_complete", "not_purchased"),
    ("first_visit_complete", "deposit_paid"),
    ("not_purchased", "first_visit_complete"),
    ("not_purchased", "closed_not_realized"),
    ("deposit_paid", "success"),
    ("success", "no_renewal"),
    ("success", "renewed"),
    ("no_renewal", "negotiation"),
]

# Reconciliation severity bands (percent).
SEVERITY_INFO_BELOW = 5.0
SEVERITY_CRITICAL_ABOVE = 10.0
ESCALATE_ABOVE = 20.0

# KPI norms (percent): metric -> (low, high).
KPI_NORMS = {"lead_to_booking": (40.0, 60.0), "booking_to_visit": (80.0, 90.0),
             "lead_to_abonement": (20.0, 30.0)}

# Default thresholds (studio 'all'); a config table may override per studio.
DEFAULT_THRESHOLDS = {
    "a01_conversion_min": 30.0,       # lead->booking % , 3 consecutive days
    "a01_days": 3.0,
    "a02_no_show_max": 25.0,          # % over 7 days
    "a02_days": 7.0,
    "a03_cac_over_mean": 20.0,        # % above the mean CAC
    "a04_mismatch_max": 10.0,         # %
    "negotiation_days": 7.0,          # A05
    "no_answer_days": 3.0,            # A06
    "lapsed_days": 30.0,              # S12 / V-11
    "closure_rate_max": 50.0,         # A12 %
    "weak_channel_conversion": 30.0,  # M-27 %
    "bottleneck_median_hours": 72.0,  # T-10
    "new_lead_sla_hours": 2.0,        # V-02
}

LTV_MONTHS = 6
RETENTION_DAYS = 90
ACTIVE_DAYS = 30
