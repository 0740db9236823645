"""Settings in layers: defaults, a YAML file, the environment, and what the caller gives."""

from __future__ import annotations

import dataclasses
import os
from pathlib import Path


@dataclasses.dataclass
class Settings:
    tiles: int = 3
    overlap: float = 0.08
    factor: int = 32
    convention: str = "auto"
    canvas_w: int = 1760
    canvas_h: int = 2464
    pad_ratio: float = 0.35
    min_pad: int = 64
    retry_pad_ratio: float = 1.2
    upscale: float = 2.0
    max_crop_side: int = 1600
    image_max_side: int = 1984
    max_join: int = 4
    min_cover: float = 0.5
    geometry_fallback: bool = True
    retype_on_checksum: bool = True
    dedup_iou: float = 0.6
    samples: int = 1
    sample_temperature: float = 0.7
    max_pixels: int = 0
    retries: int = 2


#: Where settings are looked for when none is named; the last is the one that a checkout carries.
PLACES = ("config.yaml", "config.yml", "config/default.yaml")


def find(explicit: str | None = None, env: str = "VEILFRAME_CONFIG") -> Path | None:
    """The settings file: the one named, by the caller or the environment, which must exist, else the first of PLACES that does."""
    for named in (explicit, os.environ.get(env)):
        if named:
            if not Path(named).is_file():
                raise FileNotFoundError(named)
            return Path(named)
    return next((p for p in map(Path, PLACES) if p.is_file()), None)


def load(explicit: str | None = None, overrides: dict | None = None) -> Settings:
    """Settings of all layers. Unknown names raise; None overrides nothing."""
    values: dict = {}
    if path := find(explicit):
        import yaml

        read = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
        if not isinstance(read, dict):
            raise ValueError(f"{path}: a mapping is expected")
        values |= read
    values |= {f.name: os.environ[f"VEILFRAME_{f.name.upper()}"] for f in dataclasses.fields(Settings) if f"VEILFRAME_{f.name.upper()}" in os.environ}
    values |= {k: v for k, v in (overrides or {}).items() if v is not None}
    out, known = Settings(), {f.name: f for f in dataclasses.fields(Settings)}
    for name, value in values.items():
        if name not in known:
            raise ValueError(f"unknown setting {name!r}")
        kind = type(getattr(out, name))
        if isinstance(value, str) and kind is not str:
            value = value.lower() in ("1", "true", "yes", "on") if kind is bool else kind(value)
        setattr(out, name, value)
    return out


def grid_problems(s: Settings) -> list[str]:
    """Sizes that make an encoder resample: they must be multiples of its factor, and the padding not below it."""
    sides = {"canvas_w": s.canvas_w, "canvas_h": s.canvas_h, "image_max_side": s.image_max_side}
    out = [f"{k} = {v} is no multiple of {s.factor}" for k, v in sides.items() if v > 0 and v % s.factor]
    return out + ([f"min_pad = {s.min_pad} is below {s.factor}"] if s.min_pad < s.factor else [])
