"""Settings of the jobs, from a YAML file, and where their data lie."""

from __future__ import annotations

import dataclasses
import os
import shlex
from dataclasses import dataclass
from pathlib import Path

from ..schema import STACKS, of_stack


@dataclass(frozen=True)
class Config:
    data_root: Path
    user_agent: str
    rate_limit: int
    form_types: tuple[str, ...]
    amendments: bool
    history_start: str
    gzip: bool = True
    #: Buckets of a table that is made anew; as many as a table's share for one task asks for.
    buckets: int = 16

    def raw(self, stack: str) -> Path:
        return self.data_root / of_stack(stack) / "raw"

    @property
    def tables(self) -> str:
        return str(self.data_root / "tables")

    @property
    def snapshots(self) -> Path:
        return self.data_root / "sp500" / "membership_snapshots"

    @property
    def submissions(self) -> Path:
        return self.data_root / "submissions"

    @property
    def tickers(self) -> Path:
        return self.data_root / "company_tickers.json"

    @property
    def lexicon(self) -> Path:
        return self.data_root / "lm_master_dictionary.csv"

    @property
    def labels(self) -> Path:
        return self.data_root / "sp500" / "validation_labels.csv"

    @property
    def stamp(self) -> Path:
        return self.data_root / "last_refresh.txt"

    @property
    def logs(self) -> Path:
        return self.data_root / "logs"

    def ensure(self) -> Config:
        for folder in (*(self.raw(s) for s in STACKS), self.snapshots, self.submissions, self.logs):
            folder.mkdir(parents=True, exist_ok=True)
        return self

    def quarterly(self) -> Config:
        return dataclasses.replace(self, form_types=("10-Q",))


def read_env(path: Path) -> dict[str, str]:
    """NAME=value lines of a file of settings, if it is there; quotes, `export` and comments as shells have them."""
    out = {}
    for line in path.read_text().splitlines() if path.exists() else ():
        name, found, value = line.strip().removeprefix("export ").partition("=")
        if found and name.strip().isidentifier():
            out[name.strip()] = next(iter(shlex.split(value, comments=True)), "")
    return out


def load(path: str | Path = "config.yaml") -> Config:
    """A relative data_root counts from the file's folder."""
    import yaml

    path = Path(path)
    for name, value in read_env(path.parent / ".env").items():  # what the environment has already stays
        os.environ.setdefault(name, value)
    if not path.exists():
        raise FileNotFoundError(f"{path} isn't there; copy config.example.yaml and edit it")
    raw = yaml.safe_load(path.read_text())
    root = Path(raw["paths"]["data_root"])
    universe, sec = raw["universe"], raw["sec"]
    return Config(root if root.is_absolute() else (path.parent / root).resolve(), str(sec["user_agent"]), int(sec["rate_limit_per_sec"]), tuple(universe["form_types"]), bool(universe["include_amendments"]), str(universe["history_start"]), bool((raw.get("download") or {}).get("gzip", True)), int((raw.get("tables") or {}).get("buckets", 16)))
