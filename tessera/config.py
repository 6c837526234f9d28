"""Configuration: YAML files over defaults, read on the driver."""

import copy
import os
import re

import yaml

DEFAULTS: dict[str, dict] = {
    "aggregation": {
        "spans": {"min_duration": 1.0, "max_silence_gap": 0.5, "break_on_speaker_change": True, "max_duration": 240.0},
        "beats": {"similarity_threshold": 0.7, "min_spans_per_beat": 1, "max_spans_per_beat": None, "use_embeddings": True, "max_duration": 360.0},
        "sections": {
            "target_duration_minutes": 8.0, "min_duration_minutes": 5.0, "max_duration_minutes": 12.0, "allow_semantic_overflow": True, "boundary_similarity_threshold": 0.5,
            "strong_boundary_multiplier": 0.6, "semantic_check_multiplier": 1.5, "prefer_time_boundaries": False, "require_embeddings": True,
        },
    },
    "embedding": {"model": {"provider": "hashing", "name": None}, "fallback": {"enabled": True, "provider": "hashing"}, "remote": {"api_key": None}, "generation": {"batch_size": 32, "max_text_length": 8192}},
    "validation": {"error_handling": {"fail_fast": False}},
    "quality": {},
    "routing": {},
    "speaker_roles": {"experts": [], "roles": {}, "default_role": "other"},
    "snapshot": {"root": "${SNAPSHOT_ROOT:-snapshots}", "version": {"major": 0, "minor": 1, "patch": 0, "suffix": ""}, "auto_increment": True},
}
#: Environment variables that set a key.
FROM_ENV = {"EMBEDDING_API_KEY": ("embedding", "remote", "api_key")}


def merge(base: dict, over: dict) -> dict:
    """base with over's values; dicts are merged at every depth."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def expand(value):
    """${NAME} and ${NAME:-default} from the environment, in strings at every depth."""
    if isinstance(value, dict):
        return {k: expand(v) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v) for v in value]
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", lambda m: os.environ.get(m[1]) or m[2] or "", value)
    return value


def load(folder: str | None, kind: str) -> dict:
    """<folder>/<kind>.yaml (or <kind>_config.yaml) over the defaults."""
    if kind not in DEFAULTS:
        raise ValueError(f"unknown configuration {kind!r}; known: {', '.join(DEFAULTS)}")
    out = DEFAULTS[kind]
    for name in (f"{kind}.yaml", f"{kind}_config.yaml"):
        if folder and os.path.exists(p := os.path.join(folder, name)):
            with open(p, encoding="utf-8") as f:
                out = merge(out, yaml.safe_load(f) or {})
            break
    for name, (section, *keys) in FROM_ENV.items():
        if section == kind and os.environ.get(name):
            over: dict = {keys[-1]: os.environ[name]}
            for k in reversed(keys[:-1]):
                over = {k: over}
            out = merge(out, over)
    return expand(out)


class Config:
    """Sections of a folder, each loaded when first asked for."""

    def __init__(self, folder: str | None = None) -> None:
        self.folder, self._loaded = folder, {}

    def section(self, kind: str) -> dict:
        if kind not in self._loaded:
            self._loaded[kind] = load(self.folder, kind)
        return self._loaded[kind]

    def get(self, kind: str, *keys: str, default=None):
        """A value by its keys, or the default where one is absent."""
        at = self.section(kind)
        for k in keys:
            if not isinstance(at, dict) or k not in at:
                return default
            at = at[k]
        return at

    def reload(self) -> None:
        self._loaded.clear()
