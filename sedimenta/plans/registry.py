"""Catalog of datasets and of training files, run manifests, run states and preflight checks: small files of the driver."""

from __future__ import annotations

import json
import logging
import subprocess
import time
import uuid
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sedimenta.schema import SCHEMA_VERSION
from sedimenta.sources.sinks import load_config, write_json

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DatasetEntry:
    """A dataset of the catalog."""

    name: str
    repo_id: str
    split: str
    destination: str
    enabled: bool
    config: str | None = None
    adapter: str | None = None
    streaming: bool | None = None
    shard_size: int | None = None
    license: str | None = None
    task_type: str | None = None


_KINDS = {"enabled": bool, "streaming": bool, "shard_size": int}
_REQUIRED = ("name", "repo_id", "split", "destination", "enabled")


def parse_entry(raw: dict, place: int = 0) -> DatasetEntry:
    """An entry from a dict: required keys with their types, optional ones if given; unknown keys are warned of."""
    if not isinstance(raw, dict):
        raise ValueError(f"entry {place} is not a mapping")
    names = {f.name for f in fields(DatasetEntry)}
    for k in set(raw) - names:
        log.warning("entry %d: unknown key %r", place, k)
    for k in _REQUIRED:
        if raw.get(k) is None:
            raise ValueError(f"entry {place}: {k} is missing")
    for k, v in raw.items():
        kind = _KINDS.get(k, str)
        if k in names and v is not None and (not isinstance(v, kind) or kind is int and isinstance(v, bool)):
            raise ValueError(f"entry {place}: {k} must be {kind.__name__}")
    return DatasetEntry(**{k: v for k, v in raw.items() if k in names})


def load_registry(path: str) -> list[DatasetEntry]:
    """The entries of a YAML or JSON file under ``datasets``; an empty list gives []."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    raw = load_config(path).get("datasets")
    if raw is None:
        return []
    if not isinstance(raw, list):
        raise ValueError("datasets must be a list")
    return [parse_entry(x, i) for i, x in enumerate(raw)]


def entries_of(df: DataFrame) -> list[DatasetEntry]:
    """The entries of a catalog table."""
    return [parse_entry({k: v for k, v in r.asDict().items() if v is not None}, i) for i, r in enumerate(df.collect())]


def enabled(entries: list[DatasetEntry], names: list[str] | None = None) -> list[DatasetEntry]:
    return [e for e in entries if e.enabled and (not names or e.name in names)]


class DatasetInfo:
    """The catalog of training files, ``dataset_info.json``; a malformed file counts as empty, writes are atomic."""

    def __init__(self, path: str) -> None:
        self.path = path

    @staticmethod
    def entry(file_name: str, formatting: str = "alpaca", columns: dict[str, str] | None = None) -> dict:
        return {"file_name": file_name, "formatting": formatting, "columns": columns or {"prompt": "instruction", "query": "input", "response": "output"}}

    def load(self) -> dict:
        try:
            found = json.loads(Path(self.path).read_text(encoding="utf-8"))
        except (OSError, ValueError):
            return {}
        return found if isinstance(found, dict) else {}

    def register(self, name: str, entry: dict, overwrite: bool = True) -> None:
        found = self.load()
        if name in found and not overwrite:
            raise ValueError(f"{name!r} is registered")
        write_json(self.path, found | {name: entry})

    def unregister(self, name: str) -> bool:
        found = self.load()
        if name not in found:
            return False
        write_json(self.path, {k: v for k, v in found.items() if k != name})
        return True

    def is_registered(self, name: str) -> bool:
        return name in self.load()

    def file(self, name: str) -> Path | None:
        entry = self.load().get(name)
        return Path(self.path).parent / entry["file_name"] if isinstance(entry, dict) and entry.get("file_name") else None


@dataclass
class RunManifest:
    """What a run read, was configured with and wrote."""

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    schema_version: str = SCHEMA_VERSION
    started_at: str = field(default_factory=lambda: time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))
    git_commit: str = ""
    configs: dict = field(default_factory=dict)
    files: list[str] = field(default_factory=list)
    sources: dict = field(default_factory=dict)
    mixer: dict = field(default_factory=dict)
    total_rows: int = 0

    @classmethod
    def from_run(cls, configs: dict, files: list[str], sources: dict, mixer: dict | None = None) -> RunManifest:
        got = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=False)
        return cls(git_commit=got.stdout.strip() if got.returncode == 0 else "unknown", configs=configs, files=sorted(set(files)), sources=sources, mixer=mixer or {}, total_rows=sum(s.get("yielded", 0) for s in sources.values()))

    def save(self, path: str) -> None:
        write_json(path, asdict(self))

    @classmethod
    def load(cls, path: str) -> RunManifest:
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items() if k in known})

    def summary(self) -> str:
        return f"run {self.run_id}: {self.total_rows} rows of {len(self.sources)} sources in {len(self.files)} files"


@dataclass
class ShardState:
    """Progress of one dataset; marking a shard twice counts it once."""

    dataset: str
    shards: dict[str, dict] = field(default_factory=dict)
    finished: bool = False
    updated_at: str = ""

    @property
    def completed(self) -> list[int]:
        return sorted(int(k) for k in self.shards)

    @property
    def total_rows(self) -> int:
        return sum(s["rows"] for s in self.shards.values())


class StateStore:
    """States in one JSON file per dataset; a corrupt file is warned of and counts as none."""

    def __init__(self, folder: str) -> None:
        self.folder = Path(folder)

    def _path(self, dataset: str) -> Path:
        return self.folder / f"{dataset}.json"

    def load(self, dataset: str) -> ShardState | None:
        try:
            return ShardState(**json.loads(self._path(dataset).read_text(encoding="utf-8")))
        except FileNotFoundError:
            return None
        except (OSError, ValueError, TypeError) as e:
            log.warning("state of %s cannot be read: %s", dataset, e)
            return None

    def save(self, state: ShardState) -> None:
        state.updated_at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
        write_json(str(self._path(state.dataset)), asdict(state))

    def reset(self, dataset: str) -> None:
        self._path(dataset).unlink(missing_ok=True)

    def is_shard_done(self, dataset: str, shard: int) -> bool:
        state = self.load(dataset)
        return state is not None and str(shard) in state.shards

    def mark_shard_done(self, dataset: str, shard: int, rows: int, files: list[str] | None = None) -> None:
        state = self.load(dataset) or ShardState(dataset)
        state.shards[str(shard)] = {"rows": rows, "files": files or []}
        self.save(state)

    def mark_finished(self, dataset: str) -> None:
        state = self.load(dataset) or ShardState(dataset)
        state.finished = True
        self.save(state)

    def all_states(self) -> dict[str, ShardState]:
        names = sorted(p.stem for p in self.folder.glob("*.json")) if self.folder.exists() else []
        return {n: s for n in names if (s := self.load(n))}


class PreflightError(RuntimeError):
    """A training set is not ready to be used."""


def preflight(spark: SparkSession, info: DatasetInfo, name: str) -> int:
    """Rows of a registered training file; PreflightError without catalog, entry, file or rows."""
    if not Path(info.path).exists():
        raise PreflightError(f"no catalog {info.path}")
    path = info.file(name)
    if path is None:
        raise PreflightError(f"{name!r} is not registered")
    if not path.exists():
        raise PreflightError(f"no file {path}")
    n = spark.read.text(str(path)).filter("trim(value) <> ''").count()
    if not n:
        raise PreflightError(f"{path} has no rows")
    return n
