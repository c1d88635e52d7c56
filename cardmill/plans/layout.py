"""Where the tables of a lake live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """Paths below one root. Layers: raw, staging, warehouse, quarantine, warm."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def raw(self, table: str) -> str:
        return self.path("raw", table)

    def staging(self, table: str) -> str:
        return self.path("staging", table)

    def warehouse(self, table: str) -> str:
        return self.path("warehouse", table)

    def quarantine(self, table: str) -> str:
        return self.path("quarantine", table)

    def warm(self, table: str) -> str:
        return self.path("warm", table)
