"""Logging of runs: everything to a file, the main points to the console."""

from __future__ import annotations

import logging
from pathlib import Path


def configure(path: str | None = None, name: str = "sedimenta") -> logging.Logger:
    """The package's logger with a console handler at INFO and, with ``path``, a file handler at DEBUG; calling again adds none."""
    log = logging.getLogger(name)
    log.setLevel(logging.DEBUG)
    shape = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
    kinds = {type(h) for h in log.handlers}
    if logging.StreamHandler not in kinds:
        console = logging.StreamHandler()
        console.setLevel(logging.INFO)
        console.setFormatter(shape)
        log.addHandler(console)
    if path and logging.FileHandler not in kinds:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        file = logging.FileHandler(path, encoding="utf-8")
        file.setLevel(logging.DEBUG)
        file.setFormatter(shape)
        log.addHandler(file)
    return log
