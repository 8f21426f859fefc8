"""Settings of the incident pipeline."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

# The words that name an event, in texts and as hashtags, and the
# words that tell that a post is about a plant.
EVENT_WORDS = (
    "fire", "outage", "turnarounds", "tar", "tars", "maintenance", "downtime", "cuts", "run reduction", "reduction", "throughput", "explosion", "strike",
    "problems", "capacity", "capacity reduction", "expansion", "capacity expansion", "new", "inauguration", "commissioning", "down", "run cuts", "shutdown",
    "attack", "blaze", "smoke", "cut",
)
EVENT_HASHTAGS = (
    "fire", "outage", "turnarounds", "tar", "tars", "maintenance", "downtime", "cuts", "runreduction", "run_reduction", "reduction", "throughput", "explosion",
    "strike", "problems", "capacity", "capacityreduction", "capacity_reduction", "expansion", "capacityexpansion", "capacity_expansion", "newrefinery", "new",
    "inauguration", "commissioning", "down", "runcuts", "run_cuts", "shutdown", "attack", "blaze", "smoke", "cut",
)
PLANT_WORDS = ("refining", "refinery", "refinery plant", "refineries")


@dataclass(frozen=True)
class Clustering:
    # The defaults of clustering.
    time_threshold_days: float = 7.0
    no_split_days: float = 2.0
    correlation_threshold: float = 0.4
    subsplit: bool = True
    subsplit_min_size: int = 50


@dataclass(frozen=True)
class Config:
    event_words: tuple[str, ...] = EVENT_WORDS
    event_hashtags: tuple[str, ...] = EVENT_HASHTAGS
    plant_words: tuple[str, ...] = PLANT_WORDS
    start: str = "1900-01-01"  # items before this are left as they are
    as_of: str | None = None  # the day on which open-ended validity ends; today if none
    clustering: Clustering = field(default_factory=Clustering)


def load(path: str) -> Config:
    """A Config from a JSON file; what it leaves out keeps its default."""
    with open(path) as f:
        raw = json.load(f)
    clustering = replace(Clustering(), **raw.pop("clustering", {}))
    lists = {k: tuple(v) for k, v in raw.items() if isinstance(v, list)}
    return replace(Config(), clustering=clustering, **{**raw, **lists})
