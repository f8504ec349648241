"""Typed query conditions (the reference's JSON condition object).

The reference reads a JSON object with ``startDate``, ``endDate``,
``startAge``, ``endAge`` and ``targetPageFlow``; every field is optional and an
empty string means "no bound".  Here the object is a frozen dataclass built on
the driver; only its scalar values reach Spark, as literals.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace


def _blank(v):
    return v is None or (isinstance(v, str) and v.strip() == "")


def _parse_flow(v) -> tuple[int, ...] | None:
    if _blank(v):
        return None
    if isinstance(v, str):
        return tuple(int(p) for p in v.split(",") if p.strip() != "")
    return tuple(int(p) for p in v)


# These must equal the reference's for identical results.
VISIT_LENGTH_MS = 10_000      # session length bucket, "<=" side inclusive
STEP_LENGTH = 5               # session step bucket, "<=" side inclusive
SAMPLE_SIZE = 1000            # sessions sampled in all, spread by start hour
TOP_CATEGORIES = 10           # categories ranked by click, order, pay counts
TOP_SESSIONS = 10             # sessions kept per top category
TOP_PRODUCTS = 3              # rank cut of clicked products per area
TOP_ADS = 3                   # ads kept per day and area
BLACKLIST_LIMIT = 100         # clicks per user, ad and day that ban the user
WINDOW_MINUTES = 60           # trailing window of the last-hour trend
SLIDE_SECONDS = 10            # step of that window
OTHER_LABEL = "其他"          # remark label for the share of all other cities


@dataclass(frozen=True)
class Conditions:
    # Q0 filter bounds; None (or "") means unbounded.
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    # Q5 page flow, e.g. (1, 2, 3, 4, 5, 6, 7).
    page_flow: tuple[int, ...] | None = None
    # Q1 bucket thresholds (inclusive "le" side).
    visit_length_ms: int = VISIT_LENGTH_MS
    step_length: int = STEP_LENGTH
    # Q2 proportional sample; the seed orders the hash pick.
    sample_size: int = SAMPLE_SIZE
    sample_seed: str = "42"
    # Rank cut-offs.
    top_categories: int = TOP_CATEGORIES
    top_sessions: int = TOP_SESSIONS
    top_products: int = TOP_PRODUCTS
    top_ads: int = TOP_ADS
    # Q7 clicks per (user, ad, day) that put a user on the blacklist.
    blacklist_limit: int = BLACKLIST_LIMIT
    # Q10 trailing window, whole minutes.
    window_minutes: int = WINDOW_MINUTES
    slide_seconds: int = SLIDE_SECONDS
    # Q6 remark label for the share of all other cities.
    other_label: str = OTHER_LABEL

    def __post_init__(self):
        for name in ("start_date", "end_date"):
            if _blank(getattr(self, name)):
                object.__setattr__(self, name, None)
        for name in ("start_age", "end_age"):
            v = getattr(self, name)
            object.__setattr__(self, name, None if _blank(v) else int(v))
        object.__setattr__(self, "page_flow", _parse_flow(self.page_flow))

    @classmethod
    def from_json(cls, text: str, **overrides) -> "Conditions":
        """Build from the reference's JSON condition text (camelCase keys)."""
        raw = json.loads(text) if text else {}
        return cls(
            start_date=raw.get("startDate"),
            end_date=raw.get("endDate"),
            start_age=raw.get("startAge"),
            end_age=raw.get("endAge"),
            page_flow=raw.get("targetPageFlow"),
            **overrides,
        )

    def to_json(self) -> str:
        """The condition text stored next to the Q1 result."""
        return json.dumps({
            "startDate": self.start_date or "",
            "endDate": self.end_date or "",
            "startAge": "" if self.start_age is None else str(self.start_age),
            "endAge": "" if self.end_age is None else str(self.end_age),
            "targetPageFlow": ",".join(str(p) for p in self.page_flow or ()),
        }, ensure_ascii=False)

    def with_(self, **kw) -> "Conditions":
        return replace(self, **kw)

    def require_flow(self) -> tuple[int, ...]:
        if not self.page_flow:
            raise ValueError("targetPageFlow is required for the page conversion rate")
        return self.page_flow


# Default conditions of the fixture tests (FIXTURES.md section 3).
DEFAULT_CONDITIONS = Conditions(
    start_date="2024-01-05",
    end_date="2024-01-25",
    start_age=15,
    end_age=55,
    page_flow=(1, 2, 3, 4, 5, 6, 7),
    blacklist_limit=3,
    sample_size=1000,
    sample_seed="42",
)
