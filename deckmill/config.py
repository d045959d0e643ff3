"""Thresholds, passed to operators as arguments. No global state."""

from __future__ import annotations

from dataclasses import dataclass

KIB = 1024
MIB = 1024 * 1024


@dataclass(frozen=True)
class IntegrityRules:
    min_bytes: int = 5 * KIB
    min_slides: int = 5
    max_slides: int | None = None


@dataclass(frozen=True)
class QualityRules:
    high_analytical: float = 0.50
    high_min_charts: int = 3
    medium_analytical: float = 0.40
    medium_min_charts: int = 1
    some_analytical: float = 0.20
    text_heavy_reject: float = 0.75
    photo_heavy_reject: float = 0.50
    text_heavy_chars: int = 500
    photo_heavy_chars: int = 100
    reasoning_full_hits: float = 5.0
    reasoning_pass: float = 0.3
    legacy_medium_bytes: int = 2_000_000


@dataclass(frozen=True)
class PersonalDataRules:
    """A text is flagged when a count exceeds its limit."""

    emails_allowed: int = 2
    ssns_allowed: int = 0
    phones_allowed: int = 3


@dataclass(frozen=True)
class DeliveryRules:
    high_share: float = 0.70
    medium_share: float = 0.30
    batch_size: int = 500
    min_bytes: int = 10_000
    min_slides: int = 5
    unparsed_accept_bytes: int = 50_000


@dataclass(frozen=True)
class SizeFloors:
    """Minimum deck sizes used by the different harvest routes, in bytes."""

    default: int = 5 * KIB
    delivery: int = 10_000
    legacy: int = 10 * KIB
    catalogue: int = 15 * KIB
    bulk: int = 2 * MIB
    generated: int = 5 * MIB
