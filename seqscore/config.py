"""Typed configuration (S7): explicit argument, else environment JSON,
else defaults.  Values enter plans as literals."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, fields

from seqscore import constants as C


@dataclass(frozen=True)
class ScoringConfig:
    target_organism: str = C.DEFAULT_TARGET_ORGANISM
    anionic_fraction: float = C.DEFAULT_ANIONIC_FRACTION
    hydrophobic_moment_weight: float = C.DEFAULT_HYDROPHOBIC_MOMENT_WEIGHT
    cyclicity_penalty_threshold: float = C.DEFAULT_CYCLICITY_THRESHOLD

    def to_json(self) -> str:
        return json.dumps(asdict(self))


class ConfigError(ValueError):
    pass


def load_config(arg: str | None = None, env_var: str = "SCORING_CONFIG",
                on_bad_json: str = "raise") -> ScoringConfig:
    """Parse a flat JSON object; unknown keys are ignored, missing keys
    take defaults.  ``on_bad_json`` is ``raise`` or ``default``."""
    raw = arg if arg is not None else os.environ.get(env_var)
    if not raw:
        return ScoringConfig()
    try:
        obj = json.loads(raw)
    except json.JSONDecodeError as e:
        if on_bad_json == "default":
            return ScoringConfig()
        raise ConfigError(f"cannot parse scoring config: {e}") from e
    if not isinstance(obj, dict):
        raise ConfigError("scoring config must be a JSON object")
    known = {f.name: f.type for f in fields(ScoringConfig)}
    kwargs = {}
    for k, v in obj.items():
        if k not in known:
            continue
        kwargs[k] = v if k == "target_organism" else float(v)
    return ScoringConfig(**kwargs)


def env_int(name: str, default: int) -> int:
    raw = os.environ.get(name)
    return int(raw) if raw not in (None, "") else default
