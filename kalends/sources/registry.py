"""Extension points: sources and seed finders are functions, registered by id (EXT1, EXT2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from kalends.sources.pages import LAYOUTS, cards

SOURCES: dict[str, Callable[[DataFrame], DataFrame]] = {}
SEEDS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def source(source_id: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """A function of pages (or payloads) that gives raw records."""
    SOURCES[source_id] = build


def listing_source(source_id: str, source_name: str, layout: str) -> None:
    """A source whose listing pages follow a known layout."""
    if layout not in LAYOUTS:
        raise KeyError(layout)
    source(source_id, lambda pages: cards(pages, layout, source_id, source_name))


def seed(seed_id: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """A function of pages that gives candidates."""
    SEEDS[seed_id] = build
