"""User-agent classification as CASE chains over fixed pattern lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN = "Unknown"

# Patterns tried in order, first match wins.  In the `reference` rules Chrome stands
# before Safari, Firefox and Edge, and "Mac OS X" before iPhone, so an Edge agent counts as Chrome
# and an iPhone as Mac.
REFERENCE = {
    "model": r"([A-Z0-9\-]+);?\s?\)",
    "device_type": [
        ("Android|iPhone|Mobile", "Mobile"),
        ("Windows|Macintosh|Linux", "Desktop"),
    ],
    "system": [
        ("Windows", "Windows"),
        ("Macintosh|Mac OS X", "Mac"),
        ("Android", "Android"),
        ("iPhone|iPad|iOS", "iOS"),
        ("Linux", "Linux"),
    ],
    "browser": [
        ("Chrome", "Chrome"),
        ("Safari", "Safari"),
        ("Firefox", "Firefox"),
        ("Edge", "Edge"),
        ("MSIE|Trident", "Internet Explorer"),
    ],
}

# The `precise` rules test the more specific token first.
PRECISE = {
    "model": r"Android[^;)]*;\s*([^;)]+?)(?:\s+Build/[^;)]*)?\)",
    "device_type": [
        ("iPad|Tablet", "Tablet"),
        ("Android|iPhone|iPod|Mobile", "Mobile"),
        ("Windows|Macintosh|Linux|CrOS", "Desktop"),
    ],
    "system": [
        ("iPhone|iPad|iPod", "iOS"),
        ("Windows", "Windows"),
        ("Android", "Android"),
        ("Macintosh|Mac OS X", "Mac"),
        ("Linux|CrOS", "Linux"),
    ],
    "browser": [
        ("Edge/|Edg/|EdgA/|EdgiOS/", "Edge"),
        ("OPR/|Opera", "Opera"),
        ("Firefox|FxiOS", "Firefox"),
        ("Chrome|CriOS", "Chrome"),
        ("MSIE|Trident", "Internet Explorer"),
        ("Safari", "Safari"),
    ],
}

RULES = {"reference": REFERENCE, "precise": PRECISE}


def _first_match(agent: Column, pairs: list[tuple[str, str]]) -> Column:
    chain = F
    for pattern, label in pairs:
        chain = chain.when(agent.rlike(pattern), F.lit(label))
    return chain.otherwise(F.lit(UNKNOWN))


def classify(agent: Column, rules: str = "reference") -> dict[str, Column]:
    """Columns device_type, model, system and browser of a user-agent text."""
    chosen = RULES[rules]
    return {
        "device_type": _first_match(agent, chosen["device_type"]),
        "model": F.regexp_extract(agent, chosen["model"], 1),
        "system": _first_match(agent, chosen["system"]),
        "browser": _first_match(agent, chosen["browser"]),
    }
