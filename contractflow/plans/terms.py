"""What a source promises about its deliveries, and what can be rebuilt from them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from ..errors import require
from ..functions.rules import APPEND, EVENTS, SNAPSHOT

# Per standard, the delivery kind, delete meaning, scope and baseline it needs.
NEEDED = {
    SNAPSHOT: ("complete-snapshot", "missing-keys", "full-table", None),
    EVENTS: ("change-events", "explicit-events", None, "included"),
    APPEND: ("immutable-files", "not-applicable", None, None),
}
RETAINED, NOT_RETAINED = "externally-retained", "not-retained"
LIMITS = {
    SNAPSHOT: "only the delivered snapshots; changes between them are unknown",
    EVENTS: "the baseline and every change event, deletes included",
    APPEND: "all original files",
}


@dataclass(frozen=True)
class SourceTerms:
    delivery: str
    deletes: str
    scope: str | None = None
    baseline: str | None = None
    source_deliveries: str = NOT_RETAINED
    period: str | None = None

    def check(self, standard: str) -> None:
        """Refuse a source whose promises do not fit the standard, before anything is read."""
        delivery, deletes, scope, baseline = NEEDED[standard]
        require(self.delivery == delivery, "The source's delivery kind does not fit; incremental extracts are not change events")
        require(self.deletes == deletes, "The source's delete meaning does not fit")
        require(self.scope == scope, "Snapshots cover the full table; only snapshots have a scope")
        require(self.baseline == baseline, "Change feeds include their baseline; only they have one")
        require(self.source_deliveries in (RETAINED, NOT_RETAINED), "Unknown retention")
        dated = self.period is not None and re.fullmatch(r"P[1-9][0-9]*D", self.period)
        require(
            bool(dated) if self.source_deliveries == RETAINED else self.period is None,
            "Retained deliveries state a period such as P90D; others state none",
        )

    def recovery(self, standard: str) -> dict:
        """From where, and how far, a history can be rebuilt."""
        self.check(standard)
        retained = self.source_deliveries == RETAINED
        return {
            "standard": standard,
            "capture": self.delivery,
            "replay": "external-deliveries" if retained else "unavailable",
            "retention": self.period or NOT_RETAINED,
            "needs": LIMITS[standard],
        }
