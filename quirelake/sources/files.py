"""Driver-side files: a cache of answers by key, and clearing of what an earlier run left."""

from __future__ import annotations

import hashlib
import json
import os
from pathlib import Path


def cache_path(folder: str | os.PathLike | None, key: str) -> Path | None:
    """The file of a key; None where caching is off (no folder)."""
    return Path(folder) / f"{hashlib.sha256(key.encode()).hexdigest()}.json" if folder else None


def read_cached(path: Path | None) -> object | None:
    """What a file holds; None where it is missing or broken."""
    try:
        return json.loads(path.read_text()) if path else None
    except (OSError, ValueError):
        return None


def write_cached(path: Path | None, value: object) -> None:
    """A value put in place in one step."""
    if path is None:
        return
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{os.getpid()}")
    part.write_text(json.dumps(value))
    os.replace(part, path)


def clear_crops(folder: str | os.PathLike) -> int:
    """Removes crops of an earlier run (own names only: ``p1_0.png``, ``fig_2.1.png``); how many."""
    import re

    old = [f for f in Path(folder).glob("*.png") if re.fullmatch(r"p\d+_\d+\.png|fig_[\w.-]+\.png", f.name)]
    for f in old:
        f.unlink()
    return len(old)
