"""The configuration of a guide: what the passes need to know of it, checked where it is read.

Facts and the box are the guide's; each of two sections holds what one pass needs.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from entrygraph.operators.planning import FACTS_HEAD

# The sections' and facts' names, and what counts where nothing is said.
PAGES, FEATURES = "parse-routes", "fetch-pois"
FACTS = ("title", "author", "edition", "year", "language")
MIN_TEXT_CHARS, EXCLUSION_KM, SERVICE = 200, 1.0, "https://overpass-api.de/api/interpreter"

#: Types with their (key, value) tags, in the order in which they are tried.
Tags = tuple[tuple[str, tuple[tuple[str, str], ...]], ...]


def pairs(raw: Sequence[Sequence[object]] | None) -> list[tuple[str, str]]:
    """(key, value) tuples of text from nested lists."""
    return [(str(k), str(v)) for k, v in raw or ()]


@dataclass(frozen=True)
class Guide:
    """What the passes need to know of a guide."""

    id: str
    bbox: tuple[float, float, float, float]
    facts: tuple[tuple[str, str], ...] = ()
    pdf: str = ""
    min_text_chars: int = MIN_TEXT_CHARS
    toc_pages: tuple[int, ...] = ()
    tag_map: Tags = ()
    guarded_tag_map: Tags = ()
    deduped_types: tuple[str, ...] = ()
    settlement_exclusion_km: float = EXCLUSION_KM
    out_of_scope: tuple[tuple[str, str], ...] = ()
    overpass_url: str = SERVICE

    @classmethod
    def of(cls, id: str, raw: Mapping, sections: Sequence[str] = (PAGES, FEATURES)) -> Guide:
        """From the mapping that its file holds; what a section of ``sections`` needs must be there."""

        def needed(where: Mapping, key: str, what: str):
            if where.get(key) in (None, ""):
                raise ValueError(f"guide {id}: no {key} in {what}")
            return where[key]

        if (told := needed(raw, "id", "the configuration")) != id:
            raise ValueError(f"guide {id}: its configuration is of {told}")
        box = tuple(float(x) for x in needed(raw, "bbox", "the configuration"))
        if len(box) != 4:
            raise ValueError(f"guide {id}: bbox has {len(box)} numbers, not 4")
        pages, features = raw.get(PAGES) or {}, raw.get(FEATURES) or {}
        facts = raw.get("facts") or {}
        if PAGES in sections:
            facts = {k: needed(facts, k, "facts") for k in FACTS}
            needed(pages, "pdf", PAGES)
        typed = lambda key: tuple((str(t), tuple(pairs(p))) for t, p in (features.get(key) or {}).items())
        return cls(
            id,
            box,
            tuple((k, str(facts[k])) for k in FACTS if k in facts),
            str(pages.get("pdf") or ""),
            int(pages.get("min_text_chars", MIN_TEXT_CHARS)),
            tuple(int(p) for p in pages.get("toc_pages") or ()),
            typed("tag_map"),
            typed("guarded_tag_map"),
            tuple(map(str, features.get("deduped_types") or ())),
            float(features.get("settlement_exclusion_km", EXCLUSION_KM)),
            tuple((str(needed(o, "pattern", "out_of_scope")), str(needed(o, "reason", "out_of_scope"))) for o in features.get("out_of_scope") or ()),
            str(features.get("overpass_url") or SERVICE),
        )

    def toc_stems(self) -> list[str]:
        """The file stems of the contents pages, which are numbered from 1 as the scans are."""
        return [f"page_{p:04d}" for p in self.toc_pages]

    def facts_block(self) -> str:
        """The guide's facts as readers of its pages get them."""
        return "\n".join([FACTS_HEAD, *[f"- {k.capitalize()}: {v}" for k, v in self.facts]])


def load(root: str, id: str, sections: Sequence[str] = (PAGES, FEATURES)) -> Guide:
    """The guide's configuration under ``root``: config.json, or config.yml where a YAML reader is installed."""
    folder = Path(root) / id
    if (folder / "config.json").exists():
        return Guide.of(id, json.loads((folder / "config.json").read_text(encoding="utf-8")), sections)
    if (folder / "config.yml").exists():
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("a YAML configuration needs a YAML reader; write config.json instead") from e
        return Guide.of(id, yaml.safe_load((folder / "config.yml").read_text(encoding="utf-8")) or {}, sections)
    raise FileNotFoundError(f"no configuration of guide {id!r} under {root}")
