"""Market rule packs: six YAML files, their version hash, and their form as columns and tables."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession

RULES_ROOT = Path(__file__).resolve().parent.parent / "rules"
FILES = ("table_titles", "concept_aliases", "unit_patterns", "period_patterns", "note_roles", "validation_overrides")
MARKETS = ("a_share", "hk", "us")


@dataclass(frozen=True)
class Role:
    """Keywords of one table role; all are matched without regard to case."""

    name: str
    include: tuple[str, ...] = ()
    prefer: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class RulePack:
    """The rules of a market, in file order, which decides ties."""

    market: str
    version: str
    roles: tuple[Role, ...]
    scopes: dict[str, tuple[str, ...]]
    aliases: tuple[tuple[int, str, str, float], ...]
    currencies: tuple[tuple[str, tuple[str, ...]], ...]
    scales: tuple[tuple[str, tuple[str, ...]], ...]
    periods: tuple[tuple[str, tuple[str, ...]], ...]
    notes: tuple[Role, ...]
    absolute_tolerance: Decimal
    relative_tolerance: Decimal
    rules: dict[str, dict]


def _mapping(path: Path) -> dict:
    held = yaml.safe_load(path.read_text(encoding="utf-8"))
    held = {} if held is None else held
    if not isinstance(held, dict):
        raise ValueError(f"{path} doesn't hold a mapping")
    return held


def version_of(paths: list[Path]) -> str:
    """SHA-256 over each file's name and bytes, both ended by a zero byte, in the fixed order."""
    digest = hashlib.sha256()
    for p in paths:
        digest.update(p.name.encode() + b"\0" + p.read_bytes() + b"\0")
    return digest.hexdigest()


def _roles(held: dict) -> tuple[Role, ...]:
    held = held if isinstance(held, dict) else {}
    return tuple(Role(n, *(tuple(map(str, (r or {}).get(k) or ())) for k in ("include", "prefer", "exclude"))) for n, r in held.items())


def _groups(held: dict | None) -> tuple[tuple[str, tuple[str, ...]], ...]:
    return tuple((str(k), tuple(map(str, v or ()))) for k, v in (held or {}).items())


def load(market: str, root: str | Path = RULES_ROOT, extended: bool = False) -> RulePack:
    """The pack of a market. All missing files are named in one FileNotFoundError.

    With ``extended`` the deferred note roles and the aliases of the further concepts are in it as well.
    """
    paths = [Path(root) / market / f"{f}.yml" for f in FILES]
    if missing := [str(p) for p in paths if not p.exists()]:
        raise FileNotFoundError("missing rule files: " + ", ".join(missing))
    titles, concepts, units, periods, notes, overrides = map(_mapping, paths)
    tolerance = overrides.get("tolerance")
    tolerance = tolerance if isinstance(tolerance, dict) else {}
    aliases, n = [], 0
    more = (concepts.get("further_concepts") or {}) if extended else {}
    deferred = _roles(notes.get("deferred_note_roles")) if extended else ()
    for concept, rule in [*(concepts.get("concepts") or {}).items(), *more.items()]:
        for alias in rule.get("aliases") or ():
            aliases.append((n, concept, str(alias), float(rule.get("confidence", 0.0))))
            n += 1
    scopes = titles.get("scope_keywords") or {}
    return RulePack(
        market,
        version_of(paths),
        _roles(titles.get("statement_titles")),
        {k: tuple(map(str, v or ())) for k, v in scopes.items()},
        tuple(aliases),
        _groups(units.get("currency_patterns")),
        _groups(units.get("scale_patterns")),
        _groups(periods.get("period_patterns")),
        _roles(notes.get("note_roles")) + deferred,
        Decimal(str(tolerance.get("absolute_tolerance_display_units", 2))),
        Decimal(str(tolerance.get("relative_tolerance", "0.0001"))),
        overrides.get("rules") or {},
    )


def load_all(root: str | Path = RULES_ROOT, extended: bool = False) -> dict[str, RulePack]:
    return {m: load(m, root, extended) for m in MARKETS}


def alias_table(spark: SparkSession, packs: dict[str, RulePack]) -> DataFrame:
    """(market, alias, normalized_concept_id, mapping_confidence, mapping_rule_id, concepts), one row per alias.

    Aliases are normalised as labels are; of equal ones the first in file order wins, and ``concepts``
    counts the distinct concepts that claim the alias. The planner knows the table's size, so it alone decides whether a join sends
    it to every task.
    """
    rows: dict[tuple[str, str], list] = {}
    claims: dict[tuple[str, str], set[str]] = {}
    for pack in packs.values():
        for _, concept, alias, confidence in pack.aliases:
            key = (pack.market, " ".join(alias.lower().split()))
            claims.setdefault(key, set()).add(concept)
            rows.setdefault(key, [concept, confidence, f"concept_aliases.{concept}"])
    out = [(*k, *v, len(claims[k])) for k, v in rows.items()]
    schema = pa.schema([("market", pa.string()), ("alias", pa.string()), ("normalized_concept_id", pa.string()), ("mapping_confidence", pa.float64()), ("mapping_rule_id", pa.string()), ("concepts", pa.int32())])
    columns = list(zip(*out)) or [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema))


def version_rows(spark: SparkSession, packs: dict[str, RulePack], root: str | Path, created_at) -> DataFrame:
    rows = [(p.version, m, str(Path(root) / m), created_at) for m, p in packs.items()]
    return spark.createDataFrame(rows, "rule_pack_version string, market string, rules_path string, created_at timestamp")
