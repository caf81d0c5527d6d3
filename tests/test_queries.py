import pytest

from keymend import queries
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(name, spark, same):
    same(queries.QUERIES[name](spark, DATA), queries.SQL[name])


def test_expected_values(spark):
    q = queries.QUERIES
    got = {r["map_status"]: r["n"] for r in q["keymap_status_scd1"](spark, DATA).collect()}
    assert got == {"MATCHED": 147, "ORPHAN_NEW": 16, "ORPHAN_OLD": 3}
    got = {r["bucket"]: r["fact_rows"] for r in q["impact_mixed"](spark, DATA).collect()}
    assert got == {"MATCHED": 1445, "ORPHAN_OLD": 32, "NOT_IN_LEGACY_DIM": 23}
    got = {r["bucket"]: r["fact_rows"] for r in q["fact_match_audit"](spark, DATA).collect()}
    assert got == {"MATCHED_SS_FACT": 1465, "MISSING_SS_FACT": 3, "AFTER_CUTOFF": 32}
    assert q["rekey_scd2"](spark, DATA).filter("surrogate_key = -1").count() == 9
    assert q["deterministic_sk"](spark, DATA).select("sk").distinct().count() == 150


def test_hub_versions_number_every_row(spark):
    q = queries.QUERIES
    got = [tuple(r) for r in q["hub_versions_whole"](spark, DATA).select("part_key", "version").collect()]
    assert len(got) == spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    most = {}
    for part, version in got:
        most[part] = max(most.get(part, 0), version)
    assert sorted(got) == sorted((p, v) for p, n in most.items() for v in range(1, n + 1))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1500
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
