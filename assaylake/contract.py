"""Contracts: what a dataset must look like, where it comes from and how it is judged."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

DTYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "float": T.DecimalType(18, 2),
    "integer": T.LongType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}
SEVERITIES = ("hard", "soft")


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str = "string"
    required: bool = False
    allowed: tuple[str, ...] = ()
    minimum: float | None = None
    description: str | None = None

    def __post_init__(self) -> None:
        if self.dtype not in DTYPES:
            raise ValueError(f"field {self.name}: unknown dtype {self.dtype!r}")


@dataclass(frozen=True)
class Alias:
    raw: str
    canonical: str
    transform: str | None = None


@dataclass(frozen=True)
class Source:
    source_id: str
    channel: str
    constants: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, Any] = field(default_factory=dict)
    aliases: tuple[Alias, ...] = ()
    priority: int = 100


@dataclass(frozen=True)
class RuleSpec:
    """A declared rule: kind, column, severity and parameters. Compiled by ``operators.rules``."""

    rule_id: str
    kind: str
    column: str | None = None
    severity: str = "hard"
    params: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"rule {self.rule_id}: severity must be one of {SEVERITIES}")


@dataclass(frozen=True)
class Contract:
    dataset: str
    fields: tuple[Field, ...]
    unique_fields: tuple[str, ...] = ()
    sources: tuple[Source, ...] = ()
    rules: tuple[RuleSpec, ...] = ()
    soft_categories: tuple[str, ...] = ("permissible_values",)
    version: str = "1.0"
    description: str = ""
    owner: str | None = None
    origin: str = "code"

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def source(self, source_id: str) -> Source:
        for source in self.sources:
            if source.source_id == source_id:
                return source
        raise KeyError(f"dataset {self.dataset} has no source {source_id!r}")

    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])

    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, DTYPES[f.dtype], not f.required) for f in self.fields])


# --- from mappings -------------------------------------------------------------------------------

def _fields(items: Iterable[Mapping[str, Any]]) -> tuple[Field, ...]:
    return tuple(
        Field(
            name=item["name"], dtype=item.get("dtype", "string"), required=bool(item.get("required")),
            allowed=tuple(item.get("permissible_values") or ()), minimum=item.get("min"),
            description=item.get("description"),
        )
        for item in items
    )


def _aliases(items: Iterable[Mapping[str, Any]] | None) -> tuple[Alias, ...]:
    return tuple(Alias(i["source_field"], i["canonical_field"], i.get("transform")) for i in items or ())


def contract_from_mapping(
    schema: Mapping[str, Any],
    aliasing: Mapping[str, Any] | None = None,
    quality: Mapping[str, Any] | None = None,
    origin: str = "yaml",
) -> Contract:
    """Build a contract from its schema, column-mapping and quality-rule documents."""
    by_source = {s["source_id"]: s for s in (aliasing or {}).get("sources", [])}
    sources = []
    for item in schema.get("sources", []):
        options = dict(item.get("config") or {})
        constants = {
            name: item.get(name) or options.get(name)
            for name in ("agency", "region") if item.get(name) or options.get(name)
        }
        known = {"source_id", "channel", "config", "agency", "region", "raw_columns", "note"}
        options.update({k: v for k, v in item.items() if k not in known})
        mapping = by_source.get(item["source_id"], {})
        sources.append(Source(item["source_id"], item["channel"], constants, options,
                              _aliases(mapping.get("aliases")), int(item.get("priority", 100))))
    canonical = schema["canonical_schema"]
    failures = (quality or {}).get("on_failure", {})
    return Contract(
        dataset=schema["dataset"],
        fields=_fields(canonical["fields"]),
        unique_fields=tuple(canonical.get("unique_fields", ())),
        sources=tuple(sources),
        soft_categories=tuple(failures.get("soft_rules", ("permissible_values",))),
        version=str(schema.get("version", "1.0")),
        description=(schema.get("description") or "").strip(),
        owner=schema.get("owner"),
        origin=origin,
    )


def load_contract(
    schema_path: str | Path, aliasing_path: str | Path | None = None, quality_path: str | Path | None = None,
) -> Contract:
    """Read a contract from YAML files."""
    import yaml

    def read(path: str | Path | None) -> dict | None:
        if path is None or not Path(path).exists():
            return None
        return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}

    schema = read(schema_path)
    if schema is None:
        raise FileNotFoundError(f"no dataset schema at {schema_path}")
    return contract_from_mapping(schema, read(aliasing_path), read(quality_path))


class ContractRegistry:
    """Contracts by name: configuration tables first, YAML files as the fallback, briefly cached."""

    def __init__(
        self, yaml_dir: str | Path | None = None, tables: Mapping[str, Any] | None = None,
        ttl_seconds: float = 60.0, schema_prefix: str = "schema_", aliasing_file: str = "column_aliasing.yaml",
        quality_file: str = "common_quality_rules.yaml",
    ) -> None:
        self._dir = Path(yaml_dir) if yaml_dir else None
        self._tables = tables
        self._ttl = ttl_seconds
        self._prefix, self._aliasing, self._quality = schema_prefix, aliasing_file, quality_file
        self._cache: dict[str, tuple[float, Contract]] = {}

    def get(self, dataset: str) -> Contract:
        hit = self._cache.get(dataset)
        if hit and time.monotonic() - hit[0] < self._ttl:
            return hit[1]
        contract = None
        if self._tables is not None:
            from assaylake.sources.config_tables import contract_from_tables

            try:
                contract = contract_from_tables(self._tables, dataset)
            except Exception:  # any table trouble falls back to the files, as declared
                if self._dir is None:
                    raise
        if contract is None:
            contract = self._from_yaml(dataset)
        self._cache[dataset] = (time.monotonic(), contract)
        return contract

    def _from_yaml(self, dataset: str) -> Contract:
        if self._dir is None:
            raise KeyError(f"no contract for dataset {dataset!r}")
        contract = load_contract(self._dir / f"{self._prefix}{dataset}.yaml",
                                 self._dir / self._aliasing, self._dir / self._quality)
        if contract.dataset != dataset:
            raise ValueError(f"the file for {dataset!r} declares dataset {contract.dataset!r}")
        return contract

    def names(self) -> list[str]:
        found: set[str] = set()
        if self._dir:
            found = {p.stem.removeprefix(self._prefix) for p in self._dir.glob(f"{self._prefix}*.yaml")}
        if self._tables is not None:
            from assaylake.sources.config_tables import active_datasets

            found |= {row[0] for row in active_datasets(self._tables).collect()}
        return sorted(found)

    def clear(self) -> None:
        self._cache.clear()


def with_rules(contract: Contract, rules: Iterable[RuleSpec]) -> Contract:
    return replace(contract, rules=tuple(rules))
