"""Staged versions of target files, checkpoints, all-or-nothing commit, and the manifest of conversions."""

from __future__ import annotations

import hashlib
import json
import logging
import os
import shutil
import tempfile
from dataclasses import dataclass, field
from pathlib import Path

from .pickled import dump

LOG = logging.getLogger(__name__)


class Staging:
    """New versions of files below ``root``, kept in a folder beside it until ``commit``.

    The folder goes at the end, unless a commit failed and some file could not be brought back: then it stays, with
    the old contents, and the error says where.
    """

    def __init__(self, root: Path):
        self.root = Path(root)
        self.folder = Path(tempfile.mkdtemp(prefix=".staging-", dir=self.root.parent))
        self.versions: dict[Path, Path] = {}
        self._placed: list[Path] = []
        self._keep = False

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        if not self._keep:
            shutil.rmtree(self.folder, ignore_errors=True)

    def current(self, target: Path) -> Path:
        """The staged version of a file, else the file."""
        return self.versions.get(target, target)

    def _place(self, target: Path) -> Path:
        place = self.folder / f"v{len(self._placed) + 1}" / target.relative_to(self.root)
        place.parent.mkdir(parents=True, exist_ok=True)
        self._placed.append(place)
        return place

    def stage(self, value: object, target: Path) -> None:
        place = self._place(target)
        dump(value, place)
        self.versions[target] = place

    def stage_bytes(self, stream, target: Path) -> Path:
        place = self._place(target)
        with place.open("wb") as out:
            shutil.copyfileobj(stream, out, 8 << 20)
        self.versions[target] = place
        return place

    def aside(self, stream, name: str) -> Path:
        """A copy of a delivered file, to be read and not committed."""
        place = self.folder / "read" / f"{len(self._placed) + 1}" / name
        place.parent.mkdir(parents=True, exist_ok=True)
        self._placed.append(place)
        with place.open("wb") as out:
            shutil.copyfileobj(stream, out, 8 << 20)
        return place

    def discard(self, target: Path) -> None:
        self.versions.pop(target, None)

    def checkpoint(self) -> tuple[dict[Path, Path], int]:
        return dict(self.versions), len(self._placed)

    def rollback(self, to: tuple[dict[Path, Path], int]) -> None:
        """Back to a checkpoint; what was staged since then is deleted."""
        versions, number = to
        self.versions = dict(versions)
        for place in self._placed[number:]:
            place.unlink(missing_ok=True)

    def commit(self) -> int:
        """Replace every target. All old files are set aside first, and a target is never absent: it is replaced in
        one step. Whatever interrupts, those replaced get their old contents back, and those that were new go."""
        work = sorted(self.versions.items())
        aside: dict[Path, Path] = {}
        for n, (target, _) in enumerate(work):
            if target.exists():
                aside[target] = self.folder / f"old-{n}"
                _duplicate(target, aside[target])
        touched: list[Path] = []
        try:
            for target, version in work:
                target.parent.mkdir(parents=True, exist_ok=True)
                touched.append(target)
                os.replace(version, target)
        except BaseException as error:
            lost = [t for t in reversed(touched) if not _restored(t, aside.get(t))]
            if lost:
                self._keep = True
                error.add_note(f"not restored: {', '.join(map(str, lost))}; the old contents are in {self.folder}")
            raise
        self.versions = {}
        return len(work)


def _duplicate(source: Path, place: Path) -> None:
    """A second name of a file's contents, or a copy where the file system has no links."""
    try:
        os.link(source, place)
    except OSError:
        shutil.copy2(source, place)


def _restored(target: Path, old: Path | None) -> bool:
    try:
        if old is None:
            target.unlink(missing_ok=True)
        else:
            os.replace(old, target)
    except OSError as e:
        LOG.error("%s keeps its new content: %s", target, e)
        return False
    return True


def file_digest(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


@dataclass
class Manifest:
    """Which sources were converted, by digest. A missing or unreadable file is an empty manifest."""

    path: Path
    dry_run: bool = False
    entries: dict[str, str] = field(default_factory=dict)

    @classmethod
    def read(cls, path: Path, dry_run: bool = False) -> Manifest:
        try:
            found = json.loads(path.read_text())
            if found["version"] != 1:
                raise ValueError("unknown version")
            return cls(path, dry_run, dict(found["entries"]))
        except FileNotFoundError:
            pass
        except (ValueError, KeyError, TypeError) as e:
            LOG.warning("manifest %s is ignored: %s", path, e)
        return cls(path, dry_run)

    def is_current(self, key: str, digest: str, targets: list[Path]) -> bool:
        return self.entries.get(key) == digest and all(t.exists() for t in targets)

    def record(self, key: str, digest: str) -> None:
        """Noted at once, so that an interrupted run goes on where it stopped."""
        self.entries[key] = digest
        if not self.dry_run:
            self.path.parent.mkdir(parents=True, exist_ok=True)
            part = self.path.with_name(self.path.name + ".writing")
            part.write_text(json.dumps({"version": 1, "entries": self.entries}, indent=1, sort_keys=True))
            os.replace(part, self.path)
