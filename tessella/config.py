"""Run configuration on the driver: roles, prices, run folders, snapshots, keys and hashes."""

from __future__ import annotations

import hashlib
import json
import logging
import os
import subprocess
from dataclasses import dataclass
from datetime import datetime, timezone

from .operators.gateway import Role
from .plans.spec import SpecError, load_structured


class ConfigError(ValueError):
    """A configuration or a secret that is missing or malformed.  No message holds a secret."""


@dataclass
class Config:
    raw: dict
    roles: dict[str, Role]
    prices: dict[str, dict]
    targets_dir: str
    runs_dir: str

    def section(self, name: str) -> dict:
        return self.raw.get(name) or {}

    def role(self, name: str) -> Role:
        if name not in self.roles:
            raise ConfigError(f"no role '{name}'; there are {sorted(self.roles)}")
        return self.roles[name]

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(self.raw, sort_keys=True, default=str).encode()).hexdigest()[:12]

    def price_rows(self) -> list[tuple[str, float, float]]:
        """(model, input, output) per million tokens, of the models with both prices."""
        both = ((m, p.get("input_per_1m_usd"), p.get("output_per_1m_usd")) for m, p in self.prices.items() if isinstance(p, dict))
        return [(m, float(i), float(o)) for m, i, o in both if i is not None and o is not None]


def load_config(path: str, root: str | None = None) -> Config:
    """Paths in a configuration are relative to `root`, the folder above the configuration's own by default."""
    if not os.path.exists(path):
        raise ConfigError(f"no configuration at {path}")
    root = root or os.path.dirname(os.path.dirname(os.path.abspath(path)))
    raw = load_structured(path)
    known, roles = set(Role.__dataclass_fields__) - {"name"}, {}
    for name, own in (raw.get("models") or {}).items():
        if not isinstance(own, dict) or "model" not in own:
            raise ConfigError(f"role '{name}' has no model")
        if unknown := sorted(set(own) - known):
            raise ConfigError(f"role '{name}' has unknown keys {unknown}")
        roles[name] = Role(name, **own)
    priced = os.path.join(root, raw.get("pricing_file", "configs/pricing.yaml"))
    prices = load_structured(priced).get("models") or {} if os.path.exists(priced) else {}
    return Config(raw, roles, prices, os.path.join(root, raw.get("targets_dir", "targets")), os.path.join(root, raw.get("runs_dir", "runs")))


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")


def run_dir(config: Config, target_id: str, run_id: str | None = None) -> str:
    """The folder of a run, made if it isn't there: the one named, else the target's latest, else a new one."""
    own = os.path.join(config.runs_dir, target_id)
    there = sorted(d.name for d in os.scandir(own) if d.is_dir()) if os.path.isdir(own) else []
    path = os.path.join(own, run_id or (there[-1] if there else new_run_id()))
    os.makedirs(path, exist_ok=True)
    return path


def sibling_runs(path: str, file: str = "responses.jsonl") -> dict[str, str]:
    """Target to the folder of its last run that has responses, among the runs beside that of `path`; that one included."""
    root, found = os.path.dirname(os.path.dirname(os.path.abspath(path))), {}
    for target in sorted(os.listdir(root)) if os.path.isdir(root) else []:
        runs = [r for r in sorted(os.listdir(os.path.join(root, target))) if os.path.exists(os.path.join(root, target, r, file))] if os.path.isdir(os.path.join(root, target)) else []
        if runs:
            found[target] = os.path.join(root, target, runs[-1])
    return found | {os.path.basename(os.path.dirname(os.path.abspath(path))): os.path.abspath(path)}


def snapshot(config: Config, spec_path: str, run: str) -> str:
    """Copies the resolved configuration and the specification into a run's folder; the specification's hash."""
    with open(os.path.join(run, "config.json"), "w", encoding="utf-8") as f:
        json.dump(config.raw, f, sort_keys=True, indent=2, ensure_ascii=False, default=str)
    with open(spec_path, encoding="utf-8") as f:
        text = f.read()
    with open(os.path.join(run, "spec" + os.path.splitext(spec_path)[1]), "w", encoding="utf-8") as f:
        f.write(text)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def spec_snapshot(run: str) -> dict:
    """The specification that a run's folder holds; empty where there is none or it can't be read."""
    for name in ("spec.yaml", "spec.json"):
        path = os.path.join(run, name)
        if os.path.exists(path):
            try:
                return load_structured(path)
            except (SpecError, ValueError) as e:
                logging.getLogger(__name__).warning("%s can't be read: %s", path, type(e).__name__)
                return {}
            except Exception as e:  # a YAML reader's own error type, which needs the reader to name
                logging.getLogger(__name__).warning("%s can't be read: %s", path, type(e).__name__)
                return {}
    return {}


def api_key(path: str, variable: str) -> str:
    """A key from a file, or where there is no file from an environment variable."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            if key := f.read().strip():
                return key
        raise ConfigError(f"{path} is empty")
    if key := os.environ.get(variable, "").strip():
        return key
    raise ConfigError(f"no key: {path} isn't there and {variable} is unset")


def headers(role: Role, key: str | None = None) -> dict[str, str]:
    """What a request to a role carries: its key from a file (`key`), from `env:NAME`, or none."""
    own = {"Content-Type": "application/json"}
    if role.api_key_source.startswith("env:"):
        name = role.api_key_source[4:]
        key = os.environ.get(name)
        if not key:
            raise ConfigError(f"role '{role.name}' needs the environment variable {name}")
    elif role.api_key_source == "none":
        return own
    elif not key:
        raise ConfigError(f"role '{role.name}' needs a key and none was loaded")
    return own | {"Authorization": f"Bearer {key}"}


def git_commit(root: str) -> str:
    """The commit that a tree is at, marked where it has changes; `unknown` without one."""
    try:
        run = lambda *a: subprocess.run(["git", "-C", root, *a], capture_output=True, text=True, timeout=10, check=True).stdout.strip()
        return run("rev-parse", "HEAD") + ("-dirty" if run("status", "--porcelain") else "")
    except (OSError, subprocess.SubprocessError):
        return "unknown"


def log_to(path: str) -> None:
    """Log lines to the console and to a file."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s", handlers=[logging.StreamHandler(), logging.FileHandler(path, encoding="utf-8")], force=True)
