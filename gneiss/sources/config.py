"""Per-table settings of config-driven loads."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

KINDS = ("table", "parquet", "jdbc", "format")
CLUSTER_LIMIT = 4


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class TableConfig:
    """Where a table comes from, where it goes, and how loads of it are merged."""

    source_table: str
    source_incremental_column: str
    target: str
    target_merge_columns: tuple[str, ...]
    target_incremental_column: str
    kind: str = "parquet"
    options: dict = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()

    @classmethod
    def from_dict(cls, raw: dict) -> TableConfig:
        """Check a plain mapping and name everything that is missing or unknown at once."""
        known = {f.name for f in fields(cls)}
        required = [
            "source_table", "source_incremental_column", "target", "target_merge_columns", "target_incremental_column",
        ]
        missing = [name for name in required if not raw.get(name)]
        unknown = sorted(set(raw) - known)
        if missing or unknown:
            raise ConfigError(f"missing: {missing}, unknown: {unknown}")
        values = dict(raw)
        for name in ("target_merge_columns", "cluster_by"):
            given = values.get(name, ())
            values[name] = tuple(c.strip() for c in given.split(",")) if isinstance(given, str) else tuple(given)
        config = cls(**values)
        if config.kind not in KINDS:
            raise ConfigError(f"kind {config.kind!r} is none of {KINDS}")
        if config.cluster_by and config.cluster_by != ("auto",):
            check_cluster_by(config.cluster_by)
        return config


def check_cluster_by(columns) -> list[str]:
    """A list of one to four clustering columns."""
    if not isinstance(columns, list | tuple) or not columns:
        raise ConfigError("cluster_by must be a list that is not empty")
    if len(columns) > CLUSTER_LIMIT:
        raise ConfigError(f"cluster_by takes at most {CLUSTER_LIMIT} columns")
    return list(columns)


def lookup(configs: dict[str, dict], table: str) -> TableConfig:
    if table not in configs:
        raise ConfigError(f"no configuration for table {table!r}")
    return TableConfig.from_dict({"source_table": table, **configs[table]})


def parse_flag(value) -> bool:
    """A run parameter that is a boolean or spells one."""
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise ConfigError(f"not a boolean: {value!r}")
    return text == "true"
