"""Results do not depend on the session time zone."""

import pytest

from conftest import SF_SMALL
from tickwise.plans.catalog import QUERIES


@pytest.mark.parametrize("name", ["enrich_ticks", "stream_minute_counts", "json_decode", "growth_per_minute"])
def test_same_result_in_another_zone(spark, name):
    base = sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        other = sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other
