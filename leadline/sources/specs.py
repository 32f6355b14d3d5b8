"""Which logs are read, and which of their fields carry time and type."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional


@dataclass(frozen=True)
class SourceSpec:
    name: str
    glob: str
    ts_field: str
    type_field: Optional[str]
    constant_type: str = "unknown"


# The allow-listed logs.
EVENT_SOURCES = (
    SourceSpec("agent_actions", "runtime/audit/agent-actions.jsonl", "timestamp", "operation"),
    SourceSpec("farm_supervisor", "runtime/farm-supervisor/*.log", "at", "event"),
    SourceSpec(
        "navigation",
        "runtime/navigation/collision-probes.jsonl",
        "timestamp",
        None,
        "navigation_probe",
    ),
)
