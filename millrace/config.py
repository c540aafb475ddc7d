"""Settings: a flag, else the environment, else the file, else the default."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from pathlib import Path

LINE = re.compile(r"^\s*([A-Za-z_]\w*)\s*:\s*(.*?)\s*$")


@dataclass(frozen=True)
class Config:
    warehouse: str
    raw_dir: str
    base_url: str | None = None


def read_file(path: str) -> dict[str, str]:
    """``key: value`` lines; # starts a comment; a file that isn't there is empty."""
    if not Path(path).is_file():
        return {}
    lines = (line.split("#", 1)[0] for line in Path(path).read_text().splitlines())
    return {m[1]: m[2].strip("'\"") for line in lines if (m := LINE.match(line)) and m[2]}


def resolve(warehouse: str | None = None, raw_dir: str | None = None, file: str = "millrace.yaml") -> Config:
    found = read_file(file)
    pick = lambda flag, name, default: flag or os.environ.get(f"MILLRACE_{name.upper()}") or found.get(name) or default
    return Config(pick(warehouse, "warehouse", "warehouse"), pick(raw_dir, "raw_dir", "raw"), pick(None, "base_url", None))
