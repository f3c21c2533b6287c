"""Numbered changes of stored tables, with their history."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Migration:
    version: int
    name: str
    migrate: Callable[[SparkSession, bool], dict]
    rollback: Callable[[SparkSession, bool], dict] | None = None


@dataclass
class Registry:
    """Migrations in order of version. Equal versions and gaps are errors."""

    known: dict[int, Migration] = field(default_factory=dict)

    def add(self, m: Migration) -> None:
        if m.version in self.known:
            raise ValueError(f"version {m.version} is taken by {self.known[m.version].name}")
        self.known[m.version] = m

    def check(self) -> None:
        versions = sorted(self.known)
        if versions and versions != list(range(versions[0], versions[0] + len(versions))):
            raise ValueError(f"versions have gaps: {versions}")

    def pending(self, applied: set[int]) -> list[Migration]:
        self.check()
        return [self.known[v] for v in sorted(self.known) if v not in applied]

    def run(self, spark: SparkSession, applied: set[int], dry_run: bool = False) -> list[tuple[int, str, dict]]:
        """History rows (version, status, details) of what was run; stops at the first error."""
        out = []
        for m in self.pending(applied):
            try:
                out.append((m.version, "dry-run" if dry_run else "applied", m.migrate(spark, dry_run)))
            except Exception as e:  # kept in the history, whatever it is
                return [*out, (m.version, "failed", {"error": str(e)})]
        return out

    def stamp(self, version: int, applied: set[int]) -> list[tuple[int, str, dict]]:
        """History rows that mark all migrations up to a version as applied without running them."""
        if version not in self.known:
            raise ValueError(f"version {version} is unknown")
        return [(m.version, "stamped", {"name": m.name}) for m in self.pending(applied) if m.version <= version]

    def undo(self, spark: SparkSession, version: int, dry_run: bool = False) -> dict:
        m = self.known[version]
        if m.rollback is None:
            raise ValueError(f"version {version} has no rollback")
        return m.rollback(spark, dry_run)
