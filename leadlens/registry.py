"""Registered queries: name -> (Spark builder, DuckDB oracle text).

Every builder takes ``(spark, sf_dir)``, reads the given parquet tables via
the fixture views and returns a lazy DataFrame.  Oracle texts are written
independently in SQL over the same tables (``sources/fixtures_sql.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadlens.sources.fixtures import Tables
from leadlens.sources.fixtures_sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# oracle bodies before the view prefix, so composite oracles can reuse them
ORACLE_BODY: dict[str, tuple[str, list[tuple[str, str]]]] = {}


class Ctx:
    """Inputs of one query: the raw tables and the staging tables derived from them
    (written once per run under the checkpoint folder, see ``plans/staging.py``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)
        self._memo: dict[str, DataFrame] = {}

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A staging table: written once per run, then read (see ``plans/staging.py``)."""
        if name not in self._memo:
            from leadlens.plans.staging import staged
            self._memo[name] = staged(self.spark, self.sf_dir, name, build)
        return self._memo[name]

    # common prepared inputs -------------------------------------------------
    @property
    def leads(self) -> DataFrame:
        from leadlens.plans import normalize as N
        return N.with_client_id(self.get("leads", lambda: N.keyless_leads(self.t)))

    @property
    def bookings(self) -> DataFrame:
        from leadlens.plans import normalize as N
        return self.get("bookings", lambda: N.prepared_bookings(self.t))

    @property
    def ad_leads(self) -> DataFrame:
        from leadlens.plans import normalize as N
        return self.get("ad_leads", lambda: N.prepared_ad_leads(self.t))

    @property
    def leads_booked(self) -> DataFrame:
        from leadlens.plans import normalize as N
        return N.with_client_id(self.get("leads_booked", lambda: N.attach_booking(
            self.leads.drop("client_id"), self.bookings)))

    @property
    def lead_events(self) -> DataFrame:
        from leadlens.plans import events as E
        from leadlens.sources import fixtures as fx
        # both branches of the second pass read the changes: staged, the first pass is made once
        changes = lambda: self.get("stage_changes", lambda: E.stage_changes(fx.lead_states(self.t)))
        return self.get("lead_events", lambda: E.with_previous(changes()))

    @property
    def snapshots(self) -> DataFrame:
        from leadlens.plans import events as E
        return self.get("snapshots", lambda: E.snapshots(self.lead_events))


def query(name: str, sql: str | None = None, views: list[tuple[str, str]] | None = None):
    """Register ``fn(ctx) -> DataFrame`` under ``name`` with its oracle SQL body."""

    def deco(fn: Callable[[Ctx], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Ctx(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLE[name] = with_views(sql, views)
            ORACLE_BODY[name] = (sql, list(views or []))
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    import leadlens.catalog  # noqa: F401
