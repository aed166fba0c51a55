"""Layered settings: defaults, a TOML file, overrides; keys in units of the radius are resolved once it is known."""

from __future__ import annotations

import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


def merge(low: Mapping[str, Any], high: Mapping[str, Any]) -> dict[str, Any]:
    out = dict(low)
    for k, v in high.items():
        out[k] = merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


@dataclass(frozen=True)
class Params:
    """Immutable settings passed to every stage. ``a.b`` names a nested key."""

    values: Mapping[str, Any] = field(default_factory=dict)
    radius: float | None = None

    @classmethod
    def load(cls, defaults: Mapping[str, Any], path: str | None = None, overrides: Mapping[str, Any] | None = None, radius: float | None = None) -> Params:
        values = dict(defaults)
        if path:
            with open(path, "rb") as f:
                values = merge(values, tomllib.load(f))
        return cls(merge(values, overrides or {}), radius)

    def get(self, name: str, default: Any = None) -> Any:
        at: Any = self.values
        for part in name.split("."):
            if not isinstance(at, Mapping) or part not in at:
                return default
            at = at[part]
        return at

    def __getitem__(self, name: str) -> Any:
        found = self.get(name, KeyError)
        if found is KeyError:
            raise KeyError(name)
        return found

    def __contains__(self, name: str) -> bool:
        return self.get(name, KeyError) is not KeyError

    def px(self, name: str) -> float:
        """A length: keys that end in ``_r`` are multiples of the radius, in ``_r2`` of its square."""
        v = self[name]
        if name.endswith(("_r", "_r2")):
            if self.radius is None:
                raise SystemExit(f"{name} needs the radius, which is not known yet")
            return v * (self.radius**2 if name.endswith("_r2") else self.radius)
        return v
