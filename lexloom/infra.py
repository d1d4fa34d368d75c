"""Driver-side helpers: retries, rate limits, checkpoints, configuration and logs."""

from __future__ import annotations

import functools
import json
import logging
import os
import threading
import time
from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from lexloom.functions.text import batch_id

# What is crawled, and how.
CATEGORIES = ("physics.chem-ph", "cond-mat.mtrl-sci", "physics.atm-clus", "cond-mat.soft", "physics.comp-ph", "physics.bio-ph", "q-bio.BM", "physics.atom-ph", "cs.CE")
FIRST_YEAR, LAST_YEAR = 2000, 2025
WORKERS, RETRIES, BACKOFF = 8, 3, 2.0


def retry(times: int = RETRIES, backoff: float = BACKOFF, exceptions: tuple[type[Exception], ...] = (Exception,), sleep: Callable[[float], None] = time.sleep):
    """Decorator: one call and up to `times` more, after backoff ** 0, backoff ** 1 ... seconds; the last error is raised."""

    def around(call: Callable) -> Callable:
        @functools.wraps(call)
        def run(*args: Any, **kwargs: Any) -> Any:
            for attempt in range(times):
                try:
                    return call(*args, **kwargs)
                except exceptions:
                    sleep(backoff**attempt)
            return call(*args, **kwargs)

        return run

    return around


class RateLimiter:
    """At most one pass per interval within this process, also between threads.  Divide the rate by the number of executors on a cluster."""

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.interval, self.clock, self.sleep = interval, clock, sleep
        self._lock, self._next = threading.Lock(), float("-inf")

    def wait(self) -> None:
        with self._lock:
            now = self.clock()
            if now < self._next:
                self.sleep(self._next - now)
                now = self._next
            self._next = now + self.interval


class Checkpoint:
    """A small JSON state, replaced atomically; an absent or unreadable file is an empty state."""

    def __init__(self, path: str) -> None:
        self.path = Path(path)
        try:
            self.state: dict[str, Any] = json.loads(self.path.read_text("utf-8"))
        except (OSError, ValueError):
            self.state = {}
        self._done = set(self.state.get("processed_ids", []))

    def get(self, key: str, default: Any = None) -> Any:
        return self.state.get(key, default)

    def set(self, key: str, value: Any) -> None:
        self.state[key] = value

    def is_done(self, id_: str) -> bool:
        return id_ in self._done

    def add(self, ids: Iterable[str]) -> None:
        self._done.update(ids)

    def set_offset(self, offset: int) -> None:
        self.state |= {"last_offset": offset, "last_update": datetime.now(timezone.utc).isoformat()}

    def reset(self) -> None:
        self.state, self._done = {}, set()
        self.path.unlink(missing_ok=True)

    def save(self) -> None:
        self.state["processed_ids"] = sorted(self._done)
        self.path.parent.mkdir(parents=True, exist_ok=True)
        temporary = self.path.with_suffix(f".{os.getpid()}.tmp")
        temporary.write_text(json.dumps(self.state, ensure_ascii=False), "utf-8")
        os.replace(temporary, self.path)


def batch_config(name: str | None = None, extra: dict[str, Any] | None = None) -> dict[str, Any]:
    """What describes a batch; `extra` overrides."""
    base = {"batch_id": batch_id(name), "categories": list(CATEGORIES), "first_year": FIRST_YEAR, "last_year": LAST_YEAR, "created_at": datetime.now(timezone.utc).isoformat()}
    return base | (extra or {})


class JsonFormatter(logging.Formatter):
    """One JSON object per line: timestamp, level, logger, message and, after an error, exception."""

    def format(self, record: logging.LogRecord) -> str:
        row = {"timestamp": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            row["exception"] = self.formatException(record.exc_info)
        return json.dumps(row, ensure_ascii=False)


def logger(name: str, folder: str | None = None) -> logging.Logger:
    """A logger to the console and, with a folder, to a file per day; calling it again adds no handlers."""
    log = logging.getLogger(name)
    if not log.handlers:
        log.setLevel(logging.INFO)
        log.addHandler(logging.StreamHandler())
        if folder:
            Path(folder).mkdir(parents=True, exist_ok=True)
            log.addHandler(logging.FileHandler(Path(folder) / f"{name}_{datetime.now():%Y%m%d}.jsonl", encoding="utf-8"))
            log.handlers[-1].setFormatter(JsonFormatter())
    return log


def progress(done: int, total: int, elapsed: float, done_before: int = 0) -> dict[str, float]:
    """Rate per minute and minutes to go, over what this run did."""
    rate = (done - done_before) / elapsed * 60 if elapsed > 0 else 0.0
    return {"done": done, "total": total, "per_minute": rate, "minutes_left": (total - done) / rate if rate > 0 else float("inf")}
