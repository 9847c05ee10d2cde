"""Where each layer of the lake lives, below one root URI."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def deliveries(self) -> str:
        """Silver and the deliveries behind it, as partitions `place=first` and `place=later`."""
        return f"{self.root}/silver"

    @property
    def silver(self) -> str:
        return f"{self.deliveries}/place=first"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def dashboards(self) -> str:
        return f"{self.root}/dashboards"

    @property
    def day_totals(self) -> str:
        return f"{self.root}/day_totals"

    def rolling(self, sensor: str) -> str:
        return f"{self.root}/rolling/{sensor}"

    def table(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def keys(self, name: str) -> str:
        return f"{self.root}/keys/{name}"

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/checkpoints/{stream}"
