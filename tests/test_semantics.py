"""Hazards: each base result, and the option that corrects it."""

import datetime

import pytest
from pyspark.sql import functions as F

from keymend.functions.keys import business_key_equal, natural_key, raw_key
from keymend.operators import align, corrupt, keymap, repair, report, validate
from keymend.plans import specs
from keymend.plans.run import rollback_statements, run_alignment, run_repair, run_repair_dimensions, run_report, swap_statements
from keymend.plans.specs import AlignFactSpec, DimSpec
from keymend.sources import tables

D = datetime.date
S2 = DimSpec("sk", ("nk",), 2, "a", "b")


def dims(spark):
    schema = "sk long, nk string, a date, b date"
    old = spark.createDataFrame([(1, "A", D(2024, 1, 1), D(2999, 12, 31)), (11, "A", D(2022, 1, 1), D(2023, 12, 31)), (12, "A", D(2022, 1, 1), D(2023, 12, 31))], schema)
    new = spark.createDataFrame([(3, "A", D(2024, 1, 16), D(2999, 12, 31)), (1, "A", D(2022, 1, 16), D(2024, 1, 15)), (2, "A", D(2022, 1, 16), D(2024, 1, 15))], schema)
    return old, new


def test_duplicate_windows_fan_out_unless_resolved(spark):
    old, new = dims(spark)
    a, b = keymap.snapshot(old, S2), keymap.snapshot(new, S2, "new_sk")
    fact = spark.createDataFrame([(1, D(2024, 1, 5)), (1, D(2024, 1, 15)), (11, D(2022, 1, 1))], "fk long, d date")
    got = sorted(tuple(r) for r in repair.rekey(fact, ["fk"], keymap.build_keymap(a, b, 2), 2, "d").collect())
    assert got == [(D(2022, 1, 1), -1), (D(2024, 1, 5), 1), (D(2024, 1, 5), 2), (D(2024, 1, 15), -1)]
    one = keymap.build_keymap(a, b, 2, resolve="min_new_sk")
    assert repair.rekey(fact, ["fk"], one, 2, "d").count() == 3
    assert keymap.duplicate_versions(b).count() == 1


def test_scd2_full_map_names_new_versions(spark):
    old, new = dims(spark)
    extra = new.unionByName(spark.createDataFrame([(9, "Z", D(2024, 1, 1), None)], new.schema))
    a, b = keymap.snapshot(old, S2), keymap.snapshot(extra, S2, "new_sk")
    assert keymap.build_keymap(a, b, 2).filter("map_status = 'ORPHAN_NEW'").count() == 0
    assert keymap.build_keymap(a, b, 2, full=True).filter("map_status = 'ORPHAN_NEW'").count() == 1


def test_scd2_dim_alignment_takes_smallest_or_longest(spark):
    old, new = dims(spark)
    snap = keymap.snapshot(old, S2)
    got = align.align_dim_scd2(new, S2, snap)
    assert sorted(r["sk"] for r in got.collect()) == [1, 1] and got.columns == ["sk", "nk", "a", "b"]
    best = {r["a"]: r["sk"] for r in align.align_dim_scd2(new, S2, snap, "max_overlap").collect()}
    assert best == {D(2024, 1, 16): 1, D(2022, 1, 16): 11}


def test_dim_with_own_validity_names(spark):
    own = DimSpec("sk", ("nk",), 2, "valid_from", "valid_to")
    old, new = (d.withColumnsRenamed({"a": "valid_from", "b": "valid_to"}) for d in dims(spark))
    assert align.align_dim_scd2(new, own, keymap.snapshot(old, own)).columns == ["sk", "nk", "valid_from", "valid_to"]


def test_key_normalisation(spark):
    df = spark.createDataFrame([("A", None), (None, "A"), (" a ", "\tx"), ("~null~", "x")], "p string, q string")
    got = [tuple(r) for r in df.select(natural_key(["p", "q"]), raw_key(["p", "q"])).collect()]
    assert got == [("A||~NULL~", "A"), ("~NULL~||A", "A"), ("A||\tX", " a |\tx"), ("~NULL~||X", "~null~|x")]
    one = spark.range(1).select(business_key_equal([F.lit(None).cast("string"), F.lit(" a")], [F.lit(None).cast("string"), F.lit("A")]).alias("x"), business_key_equal([F.lit(1.0)], [F.lit(1)]).alias("y")).first()
    assert one["x"] and not one["y"]
    with pytest.raises(ValueError):
        business_key_equal(["a"], [])


def test_null_keys_and_dates(spark):
    km = spark.createDataFrame([("A", 1, 7, "MATCHED")], "natural_key string, old_sk long, new_sk long, map_status string")
    fact = spark.createDataFrame([(1, None), (2, 1), (3, -1)], "id long, fk long")
    got = {r["id"]: r["fk"] for r in repair.rekey(fact, ["fk"], km).collect()}
    assert got == {1: -1, 2: 7, 3: -1}
    dim = spark.createDataFrame([(5,)], "sk long")
    assert [r["id"] for r in validate.orphans(fact, "fk", dim, "sk").collect()] == [2]
    counts = validate.key_counts(fact, ["fk"]).first()
    assert (counts["rows"], counts["unknown_fk"], counts["null_fk"]) == (3, 1, 1)
    spec = AlignFactSpec("f", "fk", "d", "l", "fk", ("id",), ("id",))
    f = fact.withColumn("d", F.lit(None).cast("date"))
    legacy = spark.createDataFrame([(2, 55)], "id long, fk long")
    assert [r["bucket"] for r in align.match_audit(f, legacy, spec, F.lit(D(2024, 1, 1))).collect()] == [None]
    km = km.selectExpr("natural_key", "old_sk", "new_sk", "cast(null as date) valid_from", "cast(null as date) valid_to", "map_status")
    out = align.align_fact(f, legacy, spec, dim, DimSpec("sk", ("sk",)), km, F.lit(D(2024, 1, 1)), with_branch=True)
    assert {r["id"]: (r["fk"], r["branch"]) for r in out.collect()}[2] == (-1, "UNKNOWN")


def test_report_kinds(spark):
    dim = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "x")], "sk long, nk string")
    gold = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "sk long, nk string")
    fact = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, -1, None)], "fk long")
    d = report.Dimension("dim", "sk", ("nk",), dim, gold, (("fact", fact, "fk"),))
    got = {r["sk"]: r["issue_type"] for r in report.issues([d], "pre").collect()}
    assert got == {2: "ORPHAN_OLD_DIM_MISSING", 3: "ORPHAN_NEW_DIM_ONLY", 4: "SILENT_CORRUPTION", 5: "FK_ORPHAN"}
    bare = report.Dimension("dim", "sk", ("nk",), dim, None, (("fact", fact, "fk"),))
    assert {r["issue_type"] for r in report.issues([bare], "pre").collect()} == {"FK_PRESENT", "FK_ORPHAN"}
    truth = {"dim": spark.createDataFrame([(4, "x")], "sk long, nk string")}
    assert 4 not in {r["sk"] for r in report.issues([d], "post", truth=truth).collect()}


def test_scd2_normaliser(spark):
    df = spark.createDataFrame([(1, "2020-01-01", "2999-12-31", True), (2, "2019-01-01", "2019-12-31", False)], "id long, valid_from string, valid_to string, is_current boolean")
    assert [(r["id"], r["recordStatus"]) for r in corrupt.normalize_scd2(df).orderBy("id").collect()] == [(1, "C"), (2, "H")]
    assert [r["recordStatus"] for r in corrupt.normalize_scd2(df.drop("is_current")).orderBy("id").collect()] == ["C", "H"]
    with pytest.raises(ValueError):
        corrupt.normalize_scd2(df.drop("valid_to"))


def test_scd2_normaliser_leaves_business_columns(spark):
    df = spark.createDataFrame([(1, "2020-01-01", "2999-12-31", "ACTIVE", 1), (2, "2019-01-01", "2019-12-31", "x", 0), (3, "2019-01-01", "2019-12-31", "x", 7)],
                               "id long, valid_from string, EffectiveEndDate string, status string, is_current int")
    got = corrupt.normalize_scd2(df).orderBy("id").collect()
    assert [(r["status"], r["recordStatus"]) for r in got] == [("ACTIVE", "C"), ("x", "H"), ("x", "7")]


def test_report_without_facts(spark):
    empty = report.issues([], "pre")
    assert empty.count() == 0 and report.flatten(empty).count() == report.summary(empty).count() == 0
    assert report.progress(report.compare(empty, empty)).first().asDict() == {"fixed": 0, "still_open": 0}


def test_runs_over_two_dimensions(spark):
    for name in ("legacy2", "gold2"):
        spark.sql(f"create schema if not exists {name}")
    make = lambda rows, schema, name: tables.save(spark.createDataFrame(rows, schema), name)
    make([(1, "a"), (2, "b")], "sk long, code string", "legacy2.cust")
    make([(1, "x"), (2, "y"), (3, "gone")], "sk long, code string", "legacy2.prod")
    make([(1, "b"), (2, "a"), (-1, "UNKNOWN")], "sk long, code string", "gold2.cust")
    make([(1, "y"), (2, "x"), (-1, "UNKNOWN")], "sk long, code string", "gold2.prod")
    make([(10, 1, 1, 2), (11, 2, 2, 3)], "id long, c long, p long, q long", "gold2.fact")
    base = {"legacy_schema": "legacy2", "legacy_sk_col": "sk", "legacy_nk_cols": "code", "new_catalog_schema": "gold2", "new_sk_col": "sk", "new_nk_cols": "code",
            "staging_schema": "staging2", "keymap_schema": "maps2", "dry_run": "false"}
    ps = [base | {"legacy_dim_table": d, "new_dim_table": d, "fact_tables": f"gold2.fact:{fks}"} for d, fks in (("cust", "c"), ("prod", "p;q"))]
    dims = [{"table": f"gold2.{d}", "golden": f"legacy2.{d}", "sk_col": "sk", "nk_cols": "code", "fact_tables": f"gold2.fact:{fks}, gold2.none:z"}
            for d, fks in (("cust", "c"), ("prod", "p;q"), ("lost", "c"))]
    pre = run_report(spark, dims, "pre")
    assert set(pre.skipped) == {"gold2.none", "gold2.lost"}
    assert {(r["dimension"], r["issue_type"], r["sk_count"]) for r in pre.frames["summary:pre"].collect()} == {
        ("cust", "SILENT_CORRUPTION", 2), ("prod", "SILENT_CORRUPTION", 2), ("prod", "FK_ORPHAN", 1)}
    wet = run_repair_dimensions(spark, ps)
    assert {r["id"]: (r["c"], r["p"], r["q"]) for r in spark.table("gold2.fact_fixed").collect()} == {10: (2, 2, 1), 11: (1, 1, -1)}
    assert wet.frames["gate:gold2.fact.q"].first()["status"] == "PASS" and "prod/keymap" in wet.frames and wet.swap_sql == swap_statements(["gold2.fact"])
    assert set(tables.properties(spark, "gold2.fact_fixed")["rekeyed_by"].split(",")) == {"maps2.cust_keymap", "maps2.prod_keymap"}
    with pytest.raises(ValueError):
        run_repair_dimensions(spark, [p | {"fact_tables": p["fact_tables"].replace("fact", "fact_fixed")} for p in ps])
    with pytest.raises(ValueError):
        run_repair_dimensions(spark, [ps[0], ps[1] | {"fact_tables": "gold2.fact:c"}])
    both = run_report(spark, dims[:2], "compare", "staging2")
    assert tables.exists(spark, "staging2.sk_integrity_report_pre") and tables.exists(spark, "staging2.sk_integrity_report_post")
    assert both.frames["progress"].first()["fixed"] == 1
    for statement in wet.swap_sql + rollback_statements(["gold2.fact"]) + wet.swap_sql:
        spark.sql(statement)
    assert {r["id"]: r["c"] for r in spark.table("gold2.fact").collect()} == {10: 2, 11: 1} and tables.exists(spark, "gold2.fact_old")


def test_numbering_is_global(spark):
    got = tables.numbered(spark.range(1000).repartition(7), [F.col("id").desc()], "n").collect()
    assert all(r["n"] == 1000 - r["id"] for r in got)


def test_parsers():
    assert specs.parse_facts("t:a;b, u:c, t:b;d") == [("t", ("a", "b", "d")), ("u", ("c",))]
    assert specs.parse_facts("t:a, t:b", merge=False) == [("t", ("a",)), ("t", ("b",))]
    assert specs.split_groups("a;b, c") == specs.split_groups("a;b,, c") == [("a", "b"), ("c",)]
    for bad in ("t", "", "t:"):
        with pytest.raises(ValueError):
            specs.parse_facts(bad)
    with pytest.raises(ValueError):
        DimSpec("sk", ("nk",), 2)
    names = specs.Names("gold.Dim_Customer", "stage", "maps")
    assert (names.snapshot, names.keymap, names.fixed("f")) == ("stage.dim_customer_snapshot", "maps.dim_customer_keymap", "f_fixed")


def test_checks(spark):
    c = validate.Checks()
    c.add("T1", "ok", True)
    c.add("T2", "bad", False, "why")
    assert [r["status"] for r in c.frame(spark).collect()] == ["PASS", "FAIL"]
    with pytest.raises(AssertionError):
        validate.Checks(True).add("T3", "bad", False)


def test_whole_runs(spark):
    spark.sql("create schema if not exists legacy")
    spark.sql("create schema if not exists gold")
    make = lambda rows, schema, name: tables.save(spark.createDataFrame(rows, schema), name)
    make([(1, "a"), (2, "b"), (3, "gone")], "sk long, code string", "legacy.dim")
    make([(1, " B"), (2, "A"), (9, "new"), (-1, "UNKNOWN")], "customer_sk long, customer_code string", "gold.dim")
    make([(10, 1, D(2024, 1, 1), "a"), (11, 2, D(2024, 1, 2), "b"), (12, 9, D(2024, 3, 1), "new"), (13, 3, D(2024, 1, 1), "gone")], "order_id long, customer_sk long, order_date date, customer_code string", "gold.fact")
    make([(10, 1), (13, 3)], "OrderID long, CustomerSK long", "legacy.FactSales")
    p = {"legacy_schema": "legacy", "legacy_dim_table": "dim", "legacy_sk_col": "sk", "legacy_nk_cols": "code", "new_catalog_schema": "gold", "new_dim_table": "dim",
         "new_sk_col": "customer_sk", "new_nk_cols": "customer_code", "fact_tables": "gold.fact:customer_sk", "staging_schema": "staging", "keymap_schema": "maps"}
    dry = run_repair(spark, p)
    assert not dry.swap_sql and not tables.exists(spark, "gold.fact_fixed")
    assert {r["map_status"]: r["n"] for r in dry.frames["status"].collect()} == {"MATCHED": 2, "ORPHAN_OLD": 1, "ORPHAN_NEW": 2}
    wet = run_repair(spark, p | {"dry_run": "false"})
    assert {r["order_id"]: r["customer_sk"] for r in spark.table("gold.fact_fixed").collect()} == {10: 2, 11: 1, 12: -1, 13: -1}
    assert wet.frames["gate:gold.fact.customer_sk"].first()["status"] == "PASS"
    assert wet.swap_sql == swap_statements(["gold.fact"]) and len(rollback_statements(["gold.fact"])) == 2
    with pytest.raises(ValueError):
        run_repair(spark, p | {"dry_run": "false", "fact_tables": "gold.fact_fixed:customer_sk"})
    a = p | {"legacy_fact_tables": "FactSales", "legacy_fact_fk_cols": "CustomerSK", "fact_event_date_cols": "order_date", "legacy_fact_bk_cols": "OrderID",
             "new_fact_bk_cols": "order_id", "fact_nk_cols": "customer_code", "cutoff_mode": "explicit", "cutoff_date": "2024-01-31"}
    plan = run_alignment(spark, a)
    assert plan.frames["orphan_new"].first()["n"] == 2 and not tables.exists(spark, "gold.dim_fixed")
    assert {r["branch"]: r["fact_rows"] for r in plan.frames["branches:gold.fact"].collect()} == {"LEGACY_FACT": 2, "NATURAL_KEY": 2}
    run_alignment(spark, a | {"dry_run": "false", "orphan_new_dim_sk_policy": "allocate_after_max"})
    assert {r["customer_code"].strip(): r["customer_sk"] for r in spark.table("gold.dim_fixed").collect()} == {"B": 2, "A": 1, "new": 4, "UNKNOWN": -1}
    assert {r["order_id"]: r["customer_sk"] for r in spark.table("gold.fact_fixed").collect()} == {10: 1, 11: 2, 12: 4, 13: 3}
    with pytest.raises(ValueError):
        run_alignment(spark, a | {"cutoff_date": ""})
    assert tables.resolve_fact(spark, "gold.fact", True) == "gold.fact_fixed" and tables.drop_all(spark, "gold") == 4
