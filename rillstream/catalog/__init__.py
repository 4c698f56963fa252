"""All registered queries, grouped by area."""

from .base import Catalog, Entry


def all_entries() -> dict[str, Entry]:
    from . import access, cards, changes, learning, relational, streaming

    merged: dict[str, Entry] = {}
    for module in (cards, relational, changes, access, learning, streaming):
        overlap = merged.keys() & module.CATALOG.keys()
        if overlap:
            raise ValueError(f"registered twice: {sorted(overlap)}")
        merged.update(module.CATALOG)
    return merged


__all__ = ["Catalog", "Entry", "all_entries"]
