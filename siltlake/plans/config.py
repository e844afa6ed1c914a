"""Configuration: JSON documents with {env} placeholders, and precedence of where values come from."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from pathlib import Path
from typing import Any


def interpolate(value: Any, values: Mapping[str, str]) -> Any:
    """value with every {name} in its strings replaced, at any depth; unknown names stay."""
    if isinstance(value, str):
        for k, v in values.items():
            value = value.replace("{" + k + "}", v)
        return value
    if isinstance(value, dict):
        return {k: interpolate(v, values) for k, v in value.items()}
    if isinstance(value, list):
        return [interpolate(v, values) for v in value]
    return value


def load(path: str, env: str) -> dict[str, Any]:
    return interpolate(json.loads(Path(path).read_text()), {"env": env})


def setting(name: str, cli: Mapping[str, Any], config: Mapping[str, Any], default: Any = None) -> Any:
    """Command line over configuration over environment over default."""
    for found in (cli.get(name), config.get(name), os.environ.get(name.upper())):
        if found not in (None, ""):
            return found
    return default


def keys_of(name: str, cli: Mapping[str, Any], config: Mapping[str, Any]) -> list[str]:
    """A table's natural key; it must be given somewhere."""
    found = setting(name, cli, config) or next((config[k] for k in ("nkey", "primary_key", "natural_key", "pk") if config.get(k)), None)
    if not found:
        raise ValueError(f"no natural key under {name}")
    return [k.strip() for k in found.split(",")] if isinstance(found, str) else list(found)


def targets(cli: Mapping[str, Any], table: Mapping[str, Any], source: Mapping[str, Any]) -> list[str]:
    """Engines to serve; the lake always comes first."""
    found = cli.get("targets") or table.get("targets") or source.get("targets") or []
    found = [t.strip() for t in found.split(",")] if isinstance(found, str) else list(found)
    return ["lake", *[t for t in found if t != "lake"]]
