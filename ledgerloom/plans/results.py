"""What the two long-running verbs report: counts under fixed names, and issues in the order in which they came up."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from enum import StrEnum


class Count(StrEnum):
    """What an update counts."""

    RISK_FILES = "risk files replaced"
    RISK_DIFFERENCES = "risk files that differ from the history"
    MATRICES = "matrices merged"
    SNAPSHOTS = "snapshots replaced"
    PACKAGES = "daily packages read"
    MINUTE_DAYS_NEW = "minute days added"
    MINUTE_DAYS_KNOWN = "minute days verified"
    WRITTEN = "files written"


#: Counts of what was read. They stay when a source's results are taken back.
OF_READING = frozenset({Count.PACKAGES, Count.MINUTE_DAYS_KNOWN})


class ObjectKind(StrEnum):
    """What a conversion makes of a source file."""

    MATRIX = "date matrices"
    SERIES = "series"
    TABLE = "plain tables"
    COPY = "other files copied"
    CURRENT = "files up to date"
    PLANNED = "files to convert"
    MINUTE_DAYS = "minute days"


@dataclass
class UpdateResult:
    issues: list[tuple[str, str]] = field(default_factory=list)
    counts: Counter[Count] = field(default_factory=Counter)
    unmatched: set[str] = field(default_factory=set)
    staged: int = 0
    committed: bool = False

    def add(self, level: str, text: str) -> None:
        self.issues.append((level, text))

    @property
    def errors(self) -> list[str]:
        return [text for level, text in self.issues if level == "error"]

    @property
    def warnings(self) -> list[str]:
        return [text for level, text in self.issues if level == "warning"]

    def summary(self) -> str:
        lines = [f"{self.counts[c]:>8,}  {c}" for c in Count]
        state = "committed" if self.committed else "nothing written"
        return "\n".join([f"{state}; {self.staged} files staged, {len(self.errors)} errors, {len(self.warnings)} warnings", *lines])


@dataclass
class ConversionResult:
    counts: Counter[ObjectKind] = field(default_factory=Counter)
    dry_run: bool = False

    def summary(self) -> str:
        return "\n".join([f"conversion{' (dry run)' if self.dry_run else ''}", *(f"{self.counts[k]:>8,}  {k}" for k in ObjectKind)])
