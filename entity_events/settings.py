"""Job parameters: what to gather, what to filter, and the run-level constant fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from entity_events import fixed_values as fixed


@dataclass(frozen=True)
class Targets:
    """Four id lists a rule is matched against; a list that is not given is empty."""

    entity_ids: tuple[str, ...] = ()
    device_ids: tuple[str, ...] = ()
    area_ids: tuple[str, ...] = ()
    label_ids: tuple[str, ...] = ()

    @classmethod
    def of(cls, ids: Mapping[str, Sequence[str]] | None) -> Targets:
        """Read the lists from a mapping keyed ``entity_id``, ``device_id``, ``area_id``, ``label_id``."""
        ids = ids or {}
        kinds = ("entity_id", "device_id", "area_id", "label_id")
        return cls(*(tuple(ids.get(kind, ())) for kind in kinds))


@dataclass(frozen=True)
class StaticFields:
    """Constant columns of a run; an empty value leaves its field out."""

    version: str | None = None
    architecture: str | None = None
    os_name: str | None = None
    hostname: str | None = None
    longitude: float | None = None
    latitude: float | None = None
    tags: tuple[str, ...] = ()

    def dotted(self) -> dict[str, Any]:
        """Return ``{field name: value}`` for the fields that are present."""
        located = self.longitude is not None and self.latitude is not None
        values = {
            "agent.version": self.version,
            "host.architecture": self.architecture,
            "host.os.name": self.os_name,
            "host.hostname": self.hostname,
            "host.location": [float(self.longitude), float(self.latitude)] if located else None,
            "tags": list(self.tags),
        }
        return {name: value for name, value in values.items() if value}


@dataclass(frozen=True)
class Settings:
    """Rules and intervals of one publishing job; an interval of 0 switches its part off."""

    publish_seconds: int = 60
    poll_seconds: int = 60
    change_types: tuple[str, ...] = (fixed.STATE, fixed.ATTRIBUTE)
    tags: tuple[str, ...] = ()
    include_enabled: bool = False
    exclude_enabled: bool = False
    include: Targets = field(default_factory=Targets)
    exclude: Targets = field(default_factory=Targets)
    audit_attributes: bool = False

    def __post_init__(self) -> None:
        if self.publish_seconds < 0 or self.poll_seconds < 0:
            raise ValueError("intervals must not be negative")
        unknown = set(self.change_types) - {fixed.STATE, fixed.ATTRIBUTE, fixed.POLLING}
        if unknown:
            raise ValueError(f"unknown change types: {sorted(unknown)}")

    @classmethod
    def from_options(cls, options: Mapping[str, Any]) -> Settings:
        """Build settings from a stored option mapping; a missing option keeps its default."""
        default = cls()
        return cls(
            publish_seconds=options.get("publish_frequency", default.publish_seconds),
            poll_seconds=options.get("polling_frequency", default.poll_seconds),
            change_types=tuple(options.get("change_detection_type", default.change_types)),
            tags=tuple(options.get("tags", ())),
            include_enabled=options.get("include_targets", False),
            exclude_enabled=options.get("exclude_targets", False),
            include=Targets.of(options.get("targets_to_include")),
            exclude=Targets.of(options.get("targets_to_exclude")),
            audit_attributes=options.get("debug_attribute_filtering", False),
        )
