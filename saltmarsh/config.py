"""Profiles and settings from files: mapping profiles in YAML, settings in dotenv files under the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

from .schema import fields_for


@dataclass(frozen=True)
class MappingProfile:
    """What a source's columns are called, and values for fields that it lacks."""

    entity: str
    columns: dict[str, str]
    defaults: dict[str, object] = field(default_factory=dict)
    sheet: str | None = None


def mapping_profile(path: str) -> MappingProfile:
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict) or not isinstance(data.get("columns"), dict):
        raise ValueError("a mapping profile has an entity and columns")
    fields_for(str(data.get("entity")))
    return MappingProfile(str(data["entity"]), {str(k): str(v) for k, v in data["columns"].items()}, dict(data.get("defaults") or {}), data.get("sheet"))


def batch_rules(path: str):
    """Exceptions of a source from a file: lists of file names."""
    import yaml

    from .operators.flows import BatchRules

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if not isinstance(data, dict):
        raise ValueError("batch rules are an object")
    lists = {}
    for key in ("category_files", "keep_bottom_only", "excluded_files"):
        names = data.get(key) or []
        if not isinstance(names, list) or not all(isinstance(n, str) for n in names):
            raise ValueError(f"{key} is a list of file names")
        lists[key] = tuple(n.strip() for n in names if n.strip())
    return BatchRules(str(data.get("source", "")), **lists)


def load_dotenv(path: str, environment: dict[str, str] | None = None) -> dict[str, str]:
    """KEY=value lines; what the environment already has is never replaced."""
    environment = os.environ if environment is None else environment
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        key, mark, value = line.partition("=")
        if mark and key.strip() and not key.lstrip().startswith("#"):
            environment.setdefault(key.strip(), value.strip().strip("\"'"))
    return environment
