"""Run settings: a JSON object laid over fixed defaults."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Mapping
from pathlib import Path
from typing import Any

from .. import dims

# Names and defaults of the settings file.

DEFAULTS: dict[str, Any] = {
    "base_url": "",
    "locale": "en",
    "district_slug": dims.DISTRICT_SLUGS[0],
    "search_path_template": dims.PATH_TEMPLATES[0][0],
    "category_path_template": dims.PATH_TEMPLATES[0][1],
    "page_param": "page",
    "max_pages_per_query": 25,
    "max_listings": None,
    "fetch_detail_pages": True,
    "collect_images": True,
    "categories": dims.CATEGORIES,
    "towns": dims.TOWNS,
    "learned_selectors": {},
}

# End of the fixed values.


class Settings(Mapping):
    """Read-only settings. Names that the engine doesn't know are an error when given by the
    caller, and passed over when they come from a file, which a later version may have written."""

    def __init__(self, **given: Any):
        if unknown := sorted(given.keys() - DEFAULTS.keys()):
            raise TypeError(f"unknown settings: {', '.join(unknown)}")
        self._given = given

    def __getitem__(self, name: str) -> Any:
        return self._given[name] if name in self._given else DEFAULTS[name]

    def __iter__(self) -> Iterator[str]:
        return iter(DEFAULTS)

    def __len__(self) -> int:
        return len(DEFAULTS)


def read_settings(path: str | Path) -> Settings:
    found = json.loads(Path(path).read_bytes())
    return Settings(**{name: found[name] for name in DEFAULTS.keys() & found.keys()})


def write_settings(settings: Mapping[str, Any], path: str | Path) -> None:
    """All settings, defaults too; the file is replaced at once."""
    folder, name = os.path.split(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    half = os.path.join(folder, f".{name}.part")
    with open(half, "w", encoding="utf-8") as out:
        json.dump(dict(settings), out, ensure_ascii=False, indent=1, sort_keys=True)
    os.replace(half, os.path.join(folder, name))
