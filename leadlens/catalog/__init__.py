"""Query catalogue: each module registers Spark queries with their oracle SQL."""

from leadlens.catalog import (alerts_q, events_q, metrics_q, normalize_q, reconcile_q,  # noqa: F401
                              reports_q, rules_q, sources_q)
