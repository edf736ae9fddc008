"""Versions of the marts: all seven change in one step.

A build writes every mart to folders of its own, ``<mart>/build=<id>/trip_month=...``, and
once all are written and checked it publishes a version: one small file, ``_versions/<n>``,
which says for each mart in which build every month folder lies.  A refresh names its own
folders for the months it built and those of the version before for all others, so nothing
is copied.  Readers take the highest number, and see either all marts of before or all of
after; a build that stops anywhere leaves the last version as it was.

A number is taken only where its file is not there yet (``create_file``).  A build that
finds versions newer than the one it began with builds on them if they changed other
months, and fails with :class:`ConcurrentBuildError` if they changed one of its own (or if
it can't tell, because they are gone): its rows may come from older bronze.

The last versions (two by default) stay readable, for readers that began before the switch.
Folders that only older ones name are deleted, as are those of builds that stopped without
publishing, a day after they began.  The driver holds one short text for each month folder
of each mart.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import SparkSession

from velomart.plans.ingest import Layout
from velomart.sources.replace import Folder, create_file, read_file

KEPT_VERSIONS = 2
UNPUBLISHED_HOURS = 24
_BUILD, _TIME = "build=", "%Y%m%d%H%M%S"

Folders = dict[str, dict[str, str]]  # mart -> month folder -> build


class ConcurrentBuildError(RuntimeError):
    """Another build has published months that this one built, too."""


@dataclass(frozen=True)
class MartVersion:
    number: int
    folders: Folders
    changed: tuple[str, ...] | None  # month folders that it replaced; None: all

    def paths(self, root: str, mart: str) -> list[str]:
        """The folders of a mart."""
        held = self.folders.get(mart, {})
        return [f"{root}/{_BUILD}{build}/{month}" for month, build in sorted(held.items())]


def new_build() -> str:
    """An id of a build, which begins with its time."""
    return f"{dt.datetime.now(dt.timezone.utc).strftime(_TIME)}-{uuid.uuid4().hex[:12]}"


def build_path(root: str, build: str) -> str:
    return f"{root}/{_BUILD}{build}"


def _store(layout: Layout) -> str:
    return f"{layout.marts.rstrip('/')}/_versions"


def published(spark: SparkSession, layout: Layout) -> list[int]:
    """Numbers of the versions that can be read, in order."""
    return sorted(int(n) for n in Folder(spark, _store(layout)).children() if n.isdigit())


def read_version(spark: SparkSession, layout: Layout, number: int) -> MartVersion:
    found = json.loads(read_file(spark, f"{_store(layout)}/{number:010d}"))
    changed = found["changed"]
    return MartVersion(number, found["folders"], None if changed is None else tuple(changed))


def current(spark: SparkSession, layout: Layout) -> MartVersion | None:
    """The latest version, or None before the first build."""
    numbers = published(spark, layout)
    return read_version(spark, layout, numbers[-1]) if numbers else None


def publish(
    spark: SparkSession,
    layout: Layout,
    base: MartVersion | None,
    build: str,
    written: dict[str, Collection[str]],
    changed: Collection[str] | None = None,
) -> MartVersion:
    """Makes the folders that ``build`` has written the latest version.

    ``written`` has the month folders of each mart; ``changed`` are the months that were
    built (one of them without a folder has no rows left), None for all.  ``base`` is the
    version that the build began with.
    """
    began = base.number if base else 0
    while True:
        now = current(spark, layout)
        last = now.number if now else 0
        for number in range(began + 1, last + 1):
            _refuse_conflict(spark, layout, number, changed)
        folders: Folders = {}
        for mart, months in written.items():
            stays = {} if changed is None or now is None else now.folders.get(mart, {})
            folders[mart] = {m: b for m, b in stays.items() if m not in changed} | {m: build for m in months}
        version = MartVersion(last + 1, folders, None if changed is None else tuple(sorted(changed)))
        text = json.dumps({"build": build, "changed": version.changed, "folders": folders}, sort_keys=True)
        if create_file(spark, f"{_store(layout)}/{version.number:010d}", text):
            return version


def _refuse_conflict(spark: SparkSession, layout: Layout, number: int, changed: Collection[str] | None) -> None:
    if number not in published(spark, layout):
        raise ConcurrentBuildError(f"version {number} of the marts came and went while they were built; build again")
    theirs = read_version(spark, layout, number).changed
    if changed is None or theirs is None or set(theirs) & set(changed):
        raise ConcurrentBuildError(f"version {number} of the marts has changed months of this build; build again")


def clean(spark: SparkSession, layout: Layout, marts: Collection[str], keep: int = KEPT_VERSIONS, unpublished_hours: float = UNPUBLISHED_HOURS) -> list[str]:
    """Deletes all but the last ``keep`` versions, the folders that only those name, and
    folders of builds that no version names some hours after their begin; returns the
    folders."""
    numbers = published(spark, layout)
    kept = [read_version(spark, layout, n) for n in numbers[-max(keep, 1) :]]
    gone = [read_version(spark, layout, n) for n in numbers[: len(numbers) - len(kept)]]
    oldest = dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=unpublished_hours)
    deleted = []
    for version in gone:
        Folder(spark, f"{_store(layout)}/{version.number:010d}").delete()
    for mart in marts:
        root = f"{layout.marts.rstrip('/')}/{mart}"
        used = {p for v in kept for p in v.paths(root, mart)}
        dropped = {p for v in gone for p in v.paths(root, mart)}
        for name in Folder(spark, root).children():
            if not name.startswith(_BUILD):
                continue
            folder = Folder(spark, f"{root}/{name}")
            began = dt.datetime.strptime(name.removeprefix(_BUILD).partition("-")[0], _TIME).replace(tzinfo=dt.timezone.utc)
            months = [f"{folder.path}/{m}" for m in folder.children() if not m.startswith(("_", "."))]
            unused = [p for p in months if p not in used and (p in dropped or began < oldest)]
            for path in unused:
                folder.delete(path)
            deleted += unused
            if len(unused) == len(months) and (unused or began < oldest):
                folder.delete()
    return deleted


def discard(spark: SparkSession, layout: Layout, marts: Collection[str], build: str) -> None:
    """Deletes what a build has written that will not be published."""
    for mart in marts:
        Folder(spark, build_path(f"{layout.marts.rstrip('/')}/{mart}", build)).delete()
