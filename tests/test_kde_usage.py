from conftest import SF_SMALL

from churnlab import schema as S


def test_all_six_densities_of_the_reference(spark):
    from churnlab.registry_more import q_kde
    got = {r[0] for r in q_kde(spark, SF_SMALL).select("feature").distinct().collect()}
    assert got == {"account_length", *S.MINUTE_COLS, "customer_service_calls"}
