import pytest

import __spark_entry__ as entry_module
import check
from sessionloom.plans import checks

SF = "/root/testdata/sf0.001"
RUNS = {"tenant_run_master", "tenant_run_activity", "one_tenant_run", "dry_run", "full_load_run", "sequence_run"}


def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.count() == 947
    assert "session_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(checks.QUERIES) <= set(entry_module.queries())
    assert set(checks.QUERIES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", [n for n in checks.QUERIES if n not in RUNS])
def test_query_matches_its_sql(spark, name):
    con = check.oracle_connection(SF)
    verdict, _ = check.compare(spark, con, SF, name)
    assert verdict.startswith("ok"), verdict
