"""Checks of the machine and the settings before a large run; pure Python on the driver, a few facts each."""

from __future__ import annotations

import importlib.util
import os
import shutil
import sys
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from ..config import Config


@dataclass(frozen=True)
class Finding:
    name: str
    status: str  # PASS, WARN or FAIL
    detail: str


def _existing(path: str) -> Path:
    """The path itself or its nearest parent that exists."""
    p = Path(path.removeprefix("file://") or ".")
    while not p.exists() and p != p.parent:
        p = p.parent
    return p


def precheck(config: Config, least_free_gb: float = 50.0, packages: tuple[str, ...] = ("pyspark", "pyarrow", "numpy"), tools: tuple[str, ...] = ("tesseract",), models: Callable[[], tuple[bool, str]] | None = None) -> list[Finding]:
    """Findings in a fixed order: Python, packages, source, output, free disk, outside tools, model service."""
    out = [Finding("python", "PASS" if sys.version_info >= (3, 10) else "FAIL", sys.version.split()[0])]
    absent = [p for p in packages if importlib.util.find_spec(p) is None]
    out.append(Finding("packages", "FAIL" if absent else "PASS", ", ".join(absent) or "all present"))
    local = lambda p: "://" not in p or p.startswith("file://")
    if local(config.source):
        source = Path(config.source.removeprefix("file://"))
        out.append(Finding("source", "PASS" if config.source and source.is_dir() and os.access(source, os.R_OK) else "FAIL", str(source)))
    else:
        out.append(Finding("source", "WARN", "not on a local file system; not looked at"))
    if local(config.output):
        near = _existing(config.output)
        out.append(Finding("output", "PASS" if config.output and os.access(near, os.W_OK) else "FAIL", str(near)))
        free = shutil.disk_usage(near).free / (1 << 30)
        out.append(Finding("free_disk", "PASS" if free >= least_free_gb else "WARN", f"{free:.1f} GB"))
    else:
        out.append(Finding("output", "WARN", "not on a local file system; not looked at"))
    missing = [t for t in tools if shutil.which(t) is None]
    needed = config.parse.ocr_mode != "skip"
    out.append(Finding("tools", "WARN" if missing and needed else "PASS", ", ".join(missing) or "all present"))
    if models is not None:
        ok, detail = models()
        out.append(Finding("models", "PASS" if ok else "FAIL", detail))
    return out


def verdict(findings: list[Finding]) -> tuple[str, int]:
    """The worst status, and the exit code: 0 for PASS and WARN, 1 for FAIL."""
    states = {f.status for f in findings}
    worst = "FAIL" if "FAIL" in states else "WARN" if "WARN" in states else "PASS"
    return worst, int(worst == "FAIL")
