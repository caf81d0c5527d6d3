"""Whole runs over named tables: dry by default, never in place, swapped by hand."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.functions.dates import cutoff
from keymend.operators import align, keymap, repair, report, validate
from keymend.plans.specs import Names, align_specs, flag, parse_facts, repair_specs, split_list
from keymend.sources.tables import ensure_schema, exists, properties, resolve_fact, save


@dataclass
class Result:
    """What a run made: frames by name, the statements to swap by hand, and tables that were not there."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    swap_sql: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


def swap_statements(names: list[str]) -> list[str]:
    """Rename pairs that put `_fixed` tables in place, in the given order (dimension before facts). For a person to run."""
    out = []
    for n in names:
        out += [f"ALTER TABLE {n} RENAME TO {n}_old", f"ALTER TABLE {n}_fixed RENAME TO {n}"]
    return out


def rollback_statements(names: list[str]) -> list[str]:
    return [s for n in reversed(names) for s in (f"ALTER TABLE {n} RENAME TO {n}_fixed", f"ALTER TABLE {n}_old RENAME TO {n}")]


def _legacy(p: dict[str, str], name: str) -> str:
    return ".".join(x for x in (p.get("foreign_catalog"), p.get("legacy_schema"), name) if x)


def _start(spark: SparkSession, p: dict[str, str]):
    names = Names(f"{p['new_catalog_schema']}.{p['new_dim_table']}", p["staging_schema"], p["keymap_schema"])
    for schema in (names.staging, names.keymaps):
        ensure_schema(spark, schema)
    return names


def _keymap(spark, p, names, old, new, result):
    legacy = _legacy(p, p["legacy_dim_table"])
    proof = keymap.provenance(legacy, names.dim)
    snap = save(keymap.snapshot(spark.table(legacy), old), names.snapshot, proof)
    current = keymap.snapshot(spark.table(names.dim), new, "new_sk")
    result.frames["legacy_duplicates"] = keymap.duplicate_keys(snap, above=0 if old.scd == 2 else 1).orderBy(F.desc("versions"), "natural_key").limit(50)
    result.frames["current_duplicates"] = keymap.duplicate_keys(current, "new_sk")
    km = save(keymap.stamped(keymap.build_keymap(snap, current, old.scd, flag(p, "full"), p.get("resolve") or None)), names.keymap, proof)
    result.frames |= {"snapshot": snap, "keymap": km, "status": keymap.status_counts(km)}
    return snap, km


def run_repair(spark: SparkSession, p: dict[str, str]) -> Result:
    """run_repair_dimensions() for one dimension."""
    return run_repair_dimensions(spark, [p])


def run_repair_dimensions(spark: SparkSession, ps: Sequence[dict[str, str]]) -> Result:
    """Snapshot, key-map and audit of each dimension; with dry_run='false' in all of them also the rebuilt facts
    `<fact>_fixed` and their checks. A fact that refers to several dimensions is rebuilt once, through all their key-maps.
    A fact that an earlier run of one of the key-maps made is refused, since re-keying twice maps new keys again.
    With several dimensions the names of their frames start with the dimension."""
    result, parts = Result(), {}
    dry = any(str(p.get("dry_run", "true")).lower() != "false" for p in ps)
    for p in ps:
        old, new, facts = repair_specs(p)
        names, own = _start(spark, p), Result()
        _, km = _keymap(spark, p, names, old, new, own)
        for f in facts:
            for fk in f.fks:
                own.frames[f"impact:{f.table}.{fk}"] = keymap.impact(spark.table(f.table), fk, km)
                if any(fk in x[0].fks for x in parts.get(f.table, [])):
                    raise ValueError(f"{f.table}.{fk} refers to two dimensions")
            parts.setdefault(f.table, []).append((f, km, old.scd, new, names, p))
        mark = f"{names.dim_id}/" if len(ps) > 1 else ""
        result.frames |= {mark + k: v for k, v in own.frames.items()}
    if dry:
        return result
    for table, roles in parts.items():
        maps = sorted({names.keymap for _, _, _, _, names, _ in roles})
        made = split_list(properties(spark, table).get("rekeyed_by", ""))
        if again := [m for m in maps if m in made]:
            raise ValueError(f"{table} was already re-keyed by {', '.join(again)}")
    for table, roles in parts.items():
        source = rebuilt = spark.table(table)
        for f, km, scd, _, _, p in roles:
            only = F.expr(p["only_where"]) if p.get("only_where") else None
            rebuilt = repair.rekey(rebuilt, f.fks, km, scd, f.event_date, _unknown(p), only)
        maps = split_list(properties(spark, table).get("rekeyed_by", "")) + [names.keymap for _, _, _, _, names, _ in roles]
        fixed = save(rebuilt, Names.fixed(table), {"rekeyed_by": ",".join(dict.fromkeys(maps))})
        result.frames[f"keys:{table}"] = validate.key_counts(fixed, [fk for f, *_ in roles for fk in f.fks], _unknown(roles[0][5]))
        for f, _, _, new, names, p in roles:
            for fk in f.fks:
                result.frames[f"gate:{table}.{fk}"] = validate.gate(source, fixed, fk, spark.table(names.dim), new.sk, table, _unknown(p))
    result.swap_sql = swap_statements(list(parts))
    return result


def _unknown(p: dict[str, str]) -> int:
    return int(p.get("unknown_member_sk") or repair.UNKNOWN)


def _reported(spark: SparkSession, dims: Sequence[dict[str, str]], use_fixed: bool, skipped: list[str]) -> list[report.Dimension]:
    """The dimensions of a report whose tables are there; names of the others go to `skipped`."""
    out = []
    for d in dims:
        if not exists(spark, d["table"]):
            skipped.append(d["table"])
            continue
        golden = d.get("golden")
        if golden and not exists(spark, golden):
            skipped.append(golden)
            golden = None
        refs = []
        for fact, fks in parse_facts(d["fact_tables"]):
            name = resolve_fact(spark, fact, use_fixed)
            if exists(spark, name):
                refs += [(fact.split(".")[-1], spark.table(name), fk) for fk in fks]
            else:
                skipped.append(name)
        out.append(report.Dimension(d["table"].split(".")[-1], d["sk_col"], tuple(split_list(d["nk_cols"])), spark.table(d["table"]),
                                    spark.table(golden) if golden else None, tuple(refs)))
    return out


def run_report(spark: SparkSession, dims: Sequence[dict[str, str]], mode: str = "compare", snapshot_schema: str | None = None) -> Result:
    """Report on `dims` (table, golden, sk_col, nk_cols, fact_tables each): with mode 'pre' over the facts as they are, with 'post'
    over their rebuilt copies where there are any, with 'compare' both side by side. Missing tables are skipped and
    named in `skipped`. With a schema, the detail of each pass is kept there as sk_integrity_report_<pass>."""
    if mode not in ("pre", "post", "compare"):
        raise ValueError(f"unknown report mode {mode!r}")
    result = Result()
    for label in ("pre", "post") if mode == "compare" else (mode,):
        detail = report.issues(_reported(spark, dims, label == "post", result.skipped), label)
        if snapshot_schema:
            ensure_schema(spark, snapshot_schema)
            detail = save(detail, f"{snapshot_schema}.sk_integrity_report_{label}")
        result.frames |= {label: detail, f"summary:{label}": report.summary(detail).orderBy("dimension", "issue_type"),
                          f"flat:{label}": report.flatten(detail).orderBy("dimension", "issue_type", "sk", "fact_table")}
    if mode == "compare":
        both = report.compare(result.frames["pre"], result.frames["post"])
        result.frames |= {"compare": both.orderBy("dimension", "sk", "issue_type"), "progress": report.progress(both)}
    return result


def run_alignment(spark: SparkSession, p: dict[str, str]) -> Result:
    """Key-map and audits; with dry_run='false' also the dimension and facts on legacy keys and their checks. The audits count, in
    a dry run too, the fact rows by the branch that gives their key. A dimension that an earlier run aligned by the same
    key-map is refused."""
    old, new, facts = align_specs(p)
    dry = str(p.get("dry_run", "true")).lower() != "false"
    unknown = int(p.get("unknown_member_sk") or align.UNKNOWN)
    names, result = _start(spark, p), Result()
    snap, km = _keymap(spark, p, names, old, new, result)
    result.frames["orphan_new"] = keymap.orphan_new_count(km)
    only = F.expr(p["keymap_only_where"]) if p.get("keymap_only_where") else None
    limit = cutoff(p.get("cutoff_mode", "d_minus_1"), p.get("cutoff_date"))
    dim = spark.table(names.dim)
    if not dry and properties(spark, names.dim).get("aligned_by") == names.keymap:
        raise ValueError(f"{names.dim} was already aligned by {names.keymap}")
    if new.scd == 1:
        aligned = align.align_dim(dim, new, km, p.get("orphan_new_dim_sk_policy", "keep_current"), snap, unknown, flag(p, "allocate_unknown"))
    else:
        aligned = align.align_dim_scd2(dim, new, snap, p.get("pick") or "min_sk")
    if not dry:
        aligned = save(aligned, names.dim_fixed, {"aligned_by": names.keymap})
        result.frames |= {"dim_rows": validate.row_counts(dim, aligned), "dim_changed": align.changed_keys(dim, aligned, new.sk, new.nks),
                          "dim_strange": align.strange_keys(aligned, new.sk, snap, unknown)}
    for f in facts:
        fact, legacy = spark.table(f.table), spark.table(_legacy(p, f.legacy_table))
        result.frames[f"match:{f.table}"] = align.match_audit(fact, legacy, f, limit)
        rebuilt = align.align_fact(fact, legacy, f, aligned, new, km, limit, unknown, flag(p, "park_missing"), only, flag(p, "dated_lookup"), True)
        result.frames[f"branches:{f.table}"] = rebuilt.groupBy("branch").agg(F.count(F.lit(1)).alias("fact_rows"))
        if dry:
            continue
        fixed = save(rebuilt.drop("branch"), Names.fixed(f.table))
        result.frames[f"stats:{f.table}"] = align.align_stats(fact, legacy, f, limit)
        result.frames[f"gate:{f.table}"] = validate.gate(fact, fixed, f.fk, aligned, new.sk, f.table, unknown)
    if not dry:
        result.swap_sql = swap_statements([names.dim, *(f.table for f in facts)])
    return result
