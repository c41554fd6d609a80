"""Settings of linkage, discovery and search (M15), and checks of what users give."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

import yaml


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Config:
    authors: str
    author_separator: str
    doi: str | None = None
    work_id: str | None = None
    chunk_size: int = 100_000  # accepted for old files; partitions make chunks needless
    organization_names: tuple[str, ...] = field(default=())
    input_name_style: str = "auto"
    reference_name_style: str = "first_last"
    name_matching_threshold: float = 0.85
    entity_extraction_enabled: bool = True
    entity_matching_threshold: float = 85.0
    use_entity_discovery: bool = True
    affiliation_name: str | None = None
    # extensions; the defaults behave like the reference
    clean_exclusion_ids: bool = False
    normalize_org_names: bool = False
    ignore_blank_affiliations: bool = False


def from_dict(values: dict, need_input: bool = True) -> Config:
    """A configuration from the nested mapping of a YAML file; unknown keys are ignored."""
    columns = values.get("input_columns") or {}
    if need_input:
        if not columns.get("doi") and not columns.get("work_id"):
            raise ConfigError("input_columns needs doi or work_id")
        for name in ("authors", "author_separator"):
            if name not in columns:
                raise ConfigError(f"input_columns needs {name}")
    plain = {k: v for k, v in values.items() if k in Config.__dataclass_fields__ and v is not None}
    plain["organization_names"] = tuple(values.get("organization_names") or ())
    search = (values.get("affiliation_search_columns") or {}).get("affiliation_name")
    ids = {k: columns.get(k) for k in ("doi", "work_id")}
    return Config(**{**plain, "authors": columns.get("authors", ""), "author_separator": columns.get("author_separator", ""), "affiliation_name": search, **ids})


def load(path: str, need_input: bool = True) -> Config:
    with open(path, encoding="utf-8") as file:
        return from_dict(yaml.safe_load(file) or {}, need_input)


def memory(text: str) -> str:
    """``8GB`` as Spark writes it, ``8g``."""
    if not re.fullmatch(r"\d+[KMGT]B", text):
        raise ConfigError(f"not a memory size: {text}")
    return text[:-1].lower()


def checked_path(path: str, output: bool = False) -> str:
    """A path without control characters and parent steps; a local input must be readable, a local output gets its folder."""
    if not path or len(path) > 4096 or re.search(r"[\x00-\x1f;'\"`|<>]", path) or ".." in path.split("/"):
        raise ConfigError(f"not a usable path: {path!r}")
    if "://" in path:
        return path
    if output:
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    elif not os.access(path, os.R_OK):
        raise ConfigError(f"cannot read {path}")
    return path


def checked_column(name: str, columns: list[str]) -> str:
    """A column that is there; names are quoted wherever they are used, so any header will do."""
    if name not in columns:
        raise ConfigError(f"no column {name!r} among {columns}")
    return name
