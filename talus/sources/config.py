"""Driver-side YAML tables and the artefact manifest."""

from __future__ import annotations

import hashlib
import json
import os
from datetime import datetime, timezone

import yaml


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def overlaid(config: dict, source: str) -> dict:
    """The defaults with the source's own block over them."""
    return {**config.get("defaults", {}), **config.get("sources", {}).get(source, {})}


def enabled(config: dict) -> list[str]:
    return [name for name in config.get("sources", {}) if overlaid(config, name).get("enabled", True)]


def aliases(config: dict) -> dict[str, str]:
    """Alias (normalised) to canonical name, the names themselves included; of two names of one alias the
    later one counts, and blank aliases do not."""
    out = {}
    for name, entry in config["skills"].items():
        for a in (name, *((entry or {}).get("aliases") or [])):
            if plain := " ".join(str(a).lower().split()):
                out[plain] = name
    return out


def rules(config: dict, label: str) -> list[tuple[str, list[str]]]:
    return [(r[label], list(map(str, r["patterns"]))) for r in config["rules"]]


def families(config: dict) -> list[dict]:
    """The taxonomy's tree as rows: domain, subdomain, code, name, aliases, typical_skills, sparse."""
    return [
        {"domain": d["code"], "subdomain": s["code"], "code": f["code"], "name": f["name"], "aliases": [str(a).lower() for a in f.get("aliases") or []], "typical_skills": list(f.get("typical_skills") or []), "sparse": bool(f.get("sparse", False))}
        for d in config["domains"] for s in d["subdomains"] for f in s["families"]
    ]


def note(manifest: str, artefact: str, rows: int, schema_version: str, produced_by: str) -> dict:
    """Append a line on an artefact to the manifest (JSON Lines); the hash covers its data files."""
    digest = hashlib.sha256()
    paths = [artefact] if os.path.isfile(artefact) else sorted(os.path.join(d, f) for d, _, fs in os.walk(artefact) for f in fs if not f.startswith(("_", ".")))
    for p in paths:
        with open(p, "rb") as f:
            for block in iter(lambda f=f: f.read(1 << 20), b""):
                digest.update(block)
    entry = {"artifact_path": artefact, "sha256": digest.hexdigest(), "rows": rows, "schema_version": schema_version, "produced_by": produced_by, "created_at": datetime.now(timezone.utc).isoformat()}
    with open(manifest, "a", encoding="utf-8") as f:
        f.write(json.dumps(entry, ensure_ascii=False) + "\n")
    return entry
