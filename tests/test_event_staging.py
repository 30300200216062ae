"""The first pass over the states is made once and staged."""

from leadlens.plans import events as E
from leadlens.plans import staging
from leadlens.registry import Ctx
from leadlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_stage_changes_are_staged(spark):
    old = spark.conf.get("leadlens.staging.enabled", "true")
    spark.conf.set("leadlens.staging.enabled", "true")
    try:
        got = Ctx(spark, SF_SMALL).lead_events
        assert "stage_changes" in {name for _, source, name in staging._STAGED if source == SF_SMALL}
        want = E.lead_events(fx.lead_states(fx.Tables(spark, SF_SMALL)))
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("leadlens.staging.enabled", old)
