"""The page queries without SQL, and the fold query, run and give rows."""
import pytest

from paths import SF_SMALL
from quarry.plans import catalog


@pytest.mark.parametrize("name", ["h2_fold_text", "i2_sitemap_extract", "i4_vehicle_cards", "i5_info_table", "i7_description",
                                  "u4_run_books", "u4_run_cars", "d14_run_report"])
def test_query_runs(spark, name):
    out = catalog.queries()[name](spark, SF_SMALL)
    assert out.columns and out.collect()
