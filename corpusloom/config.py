"""Settings: a flag given, then the environment, then a configuration file, then the default."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, fields
from pathlib import Path

FILE, PREFIX = "corpusloom.toml", "CORPUSLOOM_"


@dataclass(frozen=True)
class Settings:
    """``email`` and ``api_key`` for NCBI, the address of the PDF service, where corpora are kept."""

    email: str | None = None
    api_key: str | None = None
    pdf_service: str = "http://localhost:8070"
    root: str = "corpus"

    def shown(self) -> dict[str, str | None]:
        """For printing: of the key only its last characters."""
        out = {f.name: getattr(self, f.name) for f in fields(self)}
        if self.api_key:
            out["api_key"] = "…" + self.api_key[-4:] if len(self.api_key) > 8 else "…"
        return out

    def http(self) -> dict:
        return {k: v for k, v in (("email", self.email), ("api_key", self.api_key)) if v}


def find(start: Path | None = None, home: Path | None = None) -> Path | None:
    """The nearest configuration file of a folder and those above it, else the one of the user."""
    here = (start or Path.cwd()).resolve()
    own = (home or Path.home()) / ".config" / FILE
    return next((p for d in (here, *here.parents) if (p := d / FILE).is_file()), own if own.is_file() else None)


def load(flags: dict | None = None, env: dict | None = None, path: Path | None = None) -> Settings:
    """The settings; empty values count as not given, unknown names in the file are ignored. A file that is not TOML
    raises ValueError."""
    env, path = os.environ if env is None else env, path or find()
    try:
        told = tomllib.loads(path.read_text()) if path else {}
    except tomllib.TOMLDecodeError as e:
        raise ValueError(f"{path}: {e}") from e
    out = {}
    for f in fields(Settings):
        levels = ((flags or {}).get(f.name), env.get(PREFIX + f.name.upper()), told.get(f.name))
        out |= {f.name: v for v in [next((x for x in levels if x not in (None, "")), None)] if v is not None}
    return Settings(**out)
