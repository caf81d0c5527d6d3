"""What to repair: dimensions, facts, and the parsing and checking of flat configurations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class DimSpec:
    """Key columns of one side of a dimension; validity columns for type 2."""

    sk: str
    nks: tuple[str, ...]
    scd: int = 1
    valid_from: str | None = None
    valid_to: str | None = None

    def __post_init__(self):
        if self.scd not in (1, 2):
            raise ValueError(f"scd_type must be 1 or 2, not {self.scd!r}")
        if not self.nks:
            raise ValueError("a dimension needs a natural key")
        if self.scd == 2 and not (self.valid_from and self.valid_to):
            raise ValueError("a type-2 dimension needs both validity columns")

    def check(self, df: DataFrame) -> None:
        want = [self.sk, *self.nks, *([self.valid_from, self.valid_to] if self.scd == 2 else [])]
        if missing := [c for c in want if c not in df.columns]:
            raise ValueError(f"missing columns: {', '.join(missing)}")


@dataclass(frozen=True)
class FactSpec:
    """A fact, its foreign keys to one dimension (several roles allowed), and its event date."""

    table: str
    fks: tuple[str, ...]
    event_date: str | None = None


@dataclass(frozen=True)
class AlignFactSpec:
    """A fact with its legacy twin for alignment."""

    table: str
    fk: str
    event_date: str
    legacy_table: str
    legacy_fk: str
    legacy_bk: tuple[str, ...]
    bk: tuple[str, ...]
    nks: tuple[str, ...] = ()


@dataclass(frozen=True)
class Names:
    """Derived table names of a run."""

    dim: str
    staging: str
    keymaps: str
    facts: tuple[str, ...] = field(default=())

    @property
    def dim_id(self) -> str:
        return self.dim.split(".")[-1].lower()

    @property
    def snapshot(self) -> str:
        return f"{self.staging}.{self.dim_id}_snapshot"

    @property
    def keymap(self) -> str:
        return f"{self.keymaps}.{self.dim_id}_keymap"

    @property
    def dim_fixed(self) -> str:
        return f"{self.dim}_fixed"

    @staticmethod
    def fixed(fact: str) -> str:
        return f"{fact}_fixed"


def split_list(raw: str, sep: str = ",") -> list[str]:
    return [x.strip() for x in (raw or "").split(sep) if x.strip()]


def split_groups(raw: str) -> list[tuple[str, ...]]:
    """Groups by position: ',' between facts, ';' within one. Empty groups go, as in split_list()."""
    return [tuple(split_list(g, ";")) for g in split_list(raw)]


def flag(p: dict[str, str], name: str) -> bool:
    """An option of a flat configuration that is on when 'true'."""
    return str(p.get(name, "false")).strip().lower() == "true"


def parse_facts(raw: str, merge: bool = True) -> list[tuple[str, tuple[str, ...]]]:
    """`table:fk1;fk2, ...`. With `merge`, entries of one table become one, keys in order without
    doubles; without it each entry has one key and stands alone."""
    found: list[tuple[str, list[str]]] = []
    for entry in split_list(raw):
        name, colon, keys = entry.rpartition(":")
        fks = split_list(keys, ";") if merge else [keys.strip()]
        if not colon or not name.strip() or not fks or not fks[0]:
            raise ValueError(f"expected table:fk, got {entry!r}")
        at = next((f for f in found if merge and f[0] == name.strip()), None)
        if at is None:
            found.append((name.strip(), list(dict.fromkeys(fks))))
        else:
            at[1].extend(k for k in fks if k not in at[1])
    if not found:
        raise ValueError("no fact tables given")
    return [(n, tuple(k)) for n, k in found]


def repair_specs(p: dict[str, str]) -> tuple[DimSpec, DimSpec, list[FactSpec]]:
    """Legacy dimension, current dimension and facts from a flat configuration; raises on what doesn't fit."""
    old_nks, new_nks = split_list(p["legacy_nk_cols"]), split_list(p["new_nk_cols"])
    if len(old_nks) != len(new_nks):
        raise ValueError("legacy_nk_cols and new_nk_cols must be as many")
    scd = int(p.get("scd_type") or 1)
    facts = parse_facts(p["fact_tables"])
    dates = split_list(p.get("fact_event_date_cols", ""))
    if scd == 2 and len(dates) != len(facts):
        raise ValueError("type 2 needs one event date column for each fact")
    get = lambda k: (p.get(k) or "").strip() or None
    old = DimSpec(p["legacy_sk_col"], tuple(old_nks), scd, get("legacy_valid_from"), get("legacy_valid_to"))
    new = DimSpec(p["new_sk_col"], tuple(new_nks), scd, get("new_valid_from"), get("new_valid_to"))
    return old, new, [FactSpec(t, k, dates[i] if scd == 2 else None) for i, (t, k) in enumerate(facts)]


def align_specs(p: dict[str, str]) -> tuple[DimSpec, DimSpec, list[AlignFactSpec]]:
    """As repair_specs, for alignment: lists by position, one entry per fact."""
    old, new, _ = repair_specs(p)
    facts = parse_facts(p["fact_tables"], merge=False)
    n = len(facts)
    lists = {k: split_list(p[k]) for k in ("legacy_fact_tables", "legacy_fact_fk_cols", "fact_event_date_cols")}
    groups = {k: split_groups(p[k]) for k in ("legacy_fact_bk_cols", "new_fact_bk_cols")}
    nks = split_groups(p.get("fact_nk_cols", "")) or [()] * n
    for k, v in [*lists.items(), *groups.items(), ("fact_nk_cols", nks)]:
        if len(v) != n:
            raise ValueError(f"{k} needs {n} entries, one per fact, and has {len(v)}")
    for a, b in zip(*groups.values(), strict=True):
        if len(a) != len(b) or not a:
            raise ValueError("business keys of a fact and its legacy twin must be as many")
    if any(g and len(g) != len(new.nks) for g in nks):
        raise ValueError("fact_nk_cols must match the dimension's natural key")
    if p.get("cutoff_mode", "d_minus_1") == "explicit" and not p.get("cutoff_date"):
        raise ValueError("cutoff_mode explicit needs cutoff_date")
    if p.get("orphan_new_dim_sk_policy", "keep_current") not in ("keep_current", "allocate_after_max"):
        raise ValueError("unknown orphan_new_dim_sk_policy")
    return old, new, [
        AlignFactSpec(t, k[0], lists["fact_event_date_cols"][i], lists["legacy_fact_tables"][i], lists["legacy_fact_fk_cols"][i],
                      groups["legacy_fact_bk_cols"][i], groups["new_fact_bk_cols"][i], nks[i])
        for i, (t, k) in enumerate(facts)]
