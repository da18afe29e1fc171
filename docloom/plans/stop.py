"""Stop requests: a sentinel file or a signal, asked between the stages of a run."""

from __future__ import annotations

import signal
from pathlib import Path


class StopRequest:
    """Callable that tells whether to stop: a sentinel file exists, or one of the signals has come since it was made.

    Use it as a context manager to put the earlier signal handlers back at the end.
    """

    def __init__(self, sentinel: str | Path | None = None, signals: tuple[int, ...] = ()) -> None:
        self.sentinel, self.came = Path(sentinel) if sentinel else None, False
        self.before = {s: signal.signal(s, self._note) for s in signals}

    def _note(self, number: int, frame: object) -> None:
        self.came = True

    def __call__(self) -> bool:
        return self.came or (self.sentinel is not None and self.sentinel.exists())

    def clear(self) -> None:
        self.came = False
        if self.sentinel is not None:
            self.sentinel.unlink(missing_ok=True)

    def __enter__(self) -> StopRequest:
        return self

    def __exit__(self, *error: object) -> None:
        for s, handler in self.before.items():
            signal.signal(s, handler)
