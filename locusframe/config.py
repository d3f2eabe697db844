"""Study settings: two ordered time points, two groups, thresholds."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class StudyConfig:
    timepoints: tuple[str, str] = ("pre", "end")
    groups: tuple[str, str] = ("fat", "control")
    breadth_threshold: float = 0.1
    min_sample_num: int = 4
    p_value_threshold: float = 0.05

    def __post_init__(self) -> None:
        for name in ("timepoints", "groups"):
            value = tuple(str(x) for x in getattr(self, name))
            if len(value) != 2 or value[0] == value[1]:
                raise ValueError(f"{name} needs exactly two different labels, not {value}")
            object.__setattr__(self, name, value)

    @classmethod
    def of(cls, values: dict[str, Any]) -> StudyConfig:
        """From a mapping; names that are not set keep their defaults, others are ignored."""
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in values.items() if k in known and v is not None})

    @classmethod
    def load(cls, path: str) -> StudyConfig:
        """From a YAML file, or its subset of ``key: value`` and ``key: [a, b]`` lines."""
        text = Path(path).read_text()
        try:
            import yaml

            return cls.of(yaml.safe_load(text) or {})
        except ImportError:
            return cls.of(_plain(text))


def _plain(text: str) -> dict[str, Any]:
    def value(raw: str) -> Any:
        raw = raw.strip().strip("\"'")
        if raw.startswith("["):
            return [value(x) for x in raw.strip("[]").split(",") if x.strip()]
        for kind in (int, float):
            try:
                return kind(raw)
            except ValueError:
                pass
        return raw or None

    pairs = (line.split("#")[0].partition(":") for line in text.splitlines() if ":" in line and not line.startswith((" ", "#")))
    return {k.strip(): value(v) for k, _, v in pairs}
