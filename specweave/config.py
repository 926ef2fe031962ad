"""Settings: defaults, overlaid by a dictionary or YAML file, overlaid by environment variables; and their hash."""

from __future__ import annotations

import copy
import hashlib
import json
import os
from collections.abc import Mapping
from typing import Any

from specweave.operators import attributes, binding, chunking, cleaning, duplicates, entities, mapping, quality, signals
from specweave.sources.lexicons import Lexicon

ENV_PREFIX = "SPECWEAVE__"
DEFAULTS: dict[str, Any] = {
    "ingest": {"min_chars_per_page": cleaning.MIN_PAGE_CHARS, "ocr_page_ratio": cleaning.OCR_PAGE_RATIO},
    "chunking": {"strategy": "heading_aware", "max_tokens": chunking.MAX_TOKENS, "overlap_tokens": chunking.OVERLAP_TOKENS, "heading_split_level": chunking.SPLIT_LEVEL},
    "scoring": {"weights": {s.name: s.weight for s in signals.REGISTRY}, "accept": signals.ACCEPT, "review": signals.REVIEW},
    "binding": {"scopes": dict(binding.SCOPES), "decay": binding.DECAY, "floor": binding.FLOOR, "document_default_entity": None},
    "entities": {"origins": dict(entities.ORIGINS), "min_mentions": entities.MIN_MENTIONS, "min_confidence": entities.MIN_CONFIDENCE},
    "duplicates": {"weights": dict(duplicates.WEIGHTS), "duplicate": duplicates.DUPLICATE, "possible": duplicates.POSSIBLE},
    "quality": {"weight": quality.WEIGHT, "accept": quality.ACCEPT, "review": quality.REVIEW},
    "mapping": {"min_confidence": mapping.MIN_CONFIDENCE, "include_review_entities": False},
    "retry": {"max_attempts": 3, "backoff_seconds": 0.5},
    "output": {"graph_export": None},
    "provider": "rules",
}
assert attributes  # registers the attribute stage's constants with the package


def _merged(base: dict[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    out = copy.deepcopy(base)
    for key, value in over.items():
        out[key] = _merged(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), dict) else copy.deepcopy(value)
    return out


def _typed(text: str) -> Any:
    try:
        return json.loads(text)
    except ValueError:
        return text


def load(overrides: Mapping[str, Any] | None = None, path: str | None = None, env: Mapping[str, str] | None = None) -> dict[str, Any]:
    """Defaults, then a YAML file, then ``overrides``, then ``SPECWEAVE__section__key=value`` of the environment."""
    settings = copy.deepcopy(DEFAULTS)
    if path:
        import yaml

        with open(path, encoding="utf-8") as source:
            settings = _merged(settings, yaml.safe_load(source) or {})
    settings = _merged(settings, overrides or {})
    for name, value in (os.environ if env is None else env).items():
        if name.startswith(ENV_PREFIX):
            keys = name[len(ENV_PREFIX) :].split("__")
            nested: Any = _typed(value)
            for key in reversed(keys):
                nested = {key: nested}
            settings = _merged(settings, nested)
    return checked(settings)


def checked(settings: dict[str, Any]) -> dict[str, Any]:
    """The settings, or ValueError: thresholds in order, strategy known, weights complete and of the right sign."""
    if settings["chunking"]["strategy"] not in chunking.STRATEGIES:
        raise ValueError(f"unknown strategy {settings['chunking']['strategy']!r}")
    for section in ("scoring", "quality"):
        if not 0 <= settings[section]["review"] <= settings[section]["accept"] <= 1:
            raise ValueError(f"{section}: review must not exceed accept")
    weights = settings["scoring"]["weights"]
    if set(weights) != {s.name for s in signals.REGISTRY}:
        raise ValueError("scoring.weights must name every signal")
    if any((w < 0) != name.startswith("negative.") for name, w in weights.items()):
        raise ValueError("only negative signals have negative weights")
    if abs(sum(settings["duplicates"]["weights"].values()) - 1) > 1e-9:
        raise ValueError("duplicates.weights must sum to 1")
    return settings


def fingerprint(settings: Mapping[str, Any], lexicon: Lexicon) -> str:
    """Hash of settings and lexicon: the key under which stage outputs are kept."""
    whole = json.dumps([settings, vars(lexicon)], sort_keys=True, default=list)
    return hashlib.sha256(whole.encode()).hexdigest()[:16]
