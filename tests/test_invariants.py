"""SURVEY section 5 invariants over the TESTDATA bindings at sf0.001."""

from pyspark.sql import functions as F

from vatlens.operators import credit as cr
from vatlens.operators import kinship as kin
from vatlens.operators import ownership as own
from vatlens.sources.bindings import bind

SF = "/root/testdata/sf0.001"


def test_opacity_between_seed_extremes(spark):
    b = bind(spark, SF)
    opacity, _ = own.opacity_propagate(own.own_avg_share(own.own_clean(b.ownership)), b.opacity_seed)
    lo, hi = b.opacity_seed.agg(F.min("value"), F.max("value")).first()
    vmin, vmax, n = opacity.agg(F.min("value"), F.max("value"), F.count("value")).first()
    assert n > 0
    assert lo - 1e-9 <= vmin and vmax <= hi + 1e-9


def test_kinship_rate_is_a_percentage(spark):
    b = bind(spark, SF)
    leaves = kin.owners_natural(kin.owners_expand(own.own_clean(b.ownership)), b.opacity_seed)
    comp = kin.owners_completeness(leaves)
    rate = kin.kinship_rate(comp, kin.kin_matches(kin.owners_eligible(leaves, comp), kin.kin_edges(b.kinship)))
    bad = rate.where((F.col("kinship_rate") < 0) | (F.col("kinship_rate") > 100)).count()
    assert rate.count() > 0 and bad == 0


def test_hops_never_exceed_the_declared_caps(spark):
    b = bind(spark, SF)
    r = cr.trace_period(b.declarations, b.observations, b.ledger, b.authorisations, b.alerts, 200006)
    u = r.union
    assert u.count() > 0
    capped = u.where(F.col("origin") != 3)            # origin 3 (special credit) is uncapped by design (D4)
    over = capped.where((F.col("iva_fact_cdo") > F.col("f29_fact_reci") + 1e-6)
                        | (F.col("iva_nc_cdo") > F.col("f29_nc_reci") + 1e-6)
                        | (F.col("iva_neto_cdo") > F.col("f29_neto_reci") + 1e-6)
                        | (F.col("prop_fact_cdo") > 1) | (F.col("prop_nc_cdo") > 1)
                        | (F.col("prop_neto_cdo") > 1))
    assert over.count() == 0
