"""Settings of a run, read from YAML or a dict and validated; pure Python."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class ChunkConfig:
    size: int = 1200
    overlap: int = 200
    max_heading_len: int = 160

    def __post_init__(self) -> None:
        if not 100 <= self.size <= 10_000:
            raise ValueError("chunk size must be within 100 and 10000")
        if not 0 <= self.overlap < self.size:
            raise ValueError("overlap must be less than size")


@dataclass(frozen=True)
class ParseConfig:
    ocr_mode: str = "auto"
    max_chars: int = 5_000_000

    def __post_init__(self) -> None:
        if self.ocr_mode not in ("skip", "auto", "force"):
            raise ValueError("ocr_mode is one of skip, auto, force")


@dataclass(frozen=True)
class EmbedConfig:
    dim: int = 768
    token_budget: int = 49_152
    prefix: str = ""


@dataclass(frozen=True)
class DeltaConfig:
    run_at: str = "02:00"
    canary_globs: tuple[str, ...] = ()
    require_canary: bool = False
    max_files: int | None = None

    def __post_init__(self) -> None:
        if not re.fullmatch(r"([01]\d|2[0-3]):[0-5]\d", self.run_at):
            raise ValueError("run_at is HH:MM")


@dataclass(frozen=True)
class Config:
    source: str = ""
    output: str = ""
    parse: ParseConfig = field(default_factory=ParseConfig)
    chunk: ChunkConfig = field(default_factory=ChunkConfig)
    embed: EmbedConfig = field(default_factory=EmbedConfig)
    delta: DeltaConfig = field(default_factory=DeltaConfig)
    deferred: dict[str, str] = field(default_factory=lambda: {".dwf": "Design Web Format"})


def merged(base: dict, over: dict) -> dict:
    """``over`` on top of ``base``, dicts merged level by level."""
    return base | {k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


def from_dict(data: dict[str, Any], cls: type = Config) -> Any:
    known = {f.name: f for f in fields(cls)}
    unknown = set(data) - set(known)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    out = {}
    for k, v in data.items():
        default = known[k].default_factory() if callable(known[k].default_factory) else known[k].default
        out[k] = from_dict(v, type(default)) if is_dataclass(default) and isinstance(v, dict) else tuple(v) if isinstance(default, tuple) else v
    return cls(**out)


def load(path: str | Path, over: dict | None = None) -> Config:
    """YAML file with relative source and output resolved against the file's folder."""
    import yaml

    data = merged(yaml.safe_load(Path(path).read_text("utf-8")) or {}, over or {})
    for k in ("source", "output"):
        if data.get(k) and "://" not in data[k] and not Path(data[k]).is_absolute():
            data[k] = str((Path(path).parent / data[k]).resolve())
    return from_dict(data)


def signature(config: Config) -> str:
    """SHA-256 of the sorted settings; a checkpoint belongs to one signature."""
    return hashlib.sha256(json.dumps(asdict(config), sort_keys=True, default=str).encode()).hexdigest()
