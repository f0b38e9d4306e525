"""Folders that hold one finished state of a table, or of one day of it.

A state is written to a folder of its own and never changed into another: what points to
it is switched, in one step of the catalog. So no folder is renamed, which some stores do
by copying. Names begin with the time, so without a catalog the newest finished folder
tells what the table held.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from accountloom.sources import files

ALL = "all"


@dataclass(frozen=True, order=True)
class Version:
    """stamp orders versions; of is "all", or the day that the folder holds."""

    stamp: str
    of: str
    folder: str

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.name}"

    @property
    def name(self) -> str:
        # Listings skip names that begin with an underscore.
        return f"_version-{self.stamp}-{self.of}"


def new_version(folder: str, of: str) -> Version:
    return Version(f"{time.time_ns():020d}{uuid.uuid4().hex[:8]}", of, folder)


def finished(spark: SparkSession, folder: str) -> list[Version]:
    """All versions whose write has ended, oldest first."""
    found = []
    for name in files.names(spark, folder):
        if name.startswith("_version-"):
            _, stamp, of = name.split("-", 2)
            if files.exists(spark, f"{folder}/{name}/_SUCCESS"):
                found.append(Version(stamp, of, folder))
    return sorted(found)


def current(versions: list[Version]) -> tuple[Version | None, dict[str, Version]]:
    """The newest whole state and, by day, what replaced a day of it since."""
    base, days = None, {}
    for version in versions:
        if version.of == ALL:
            base, days = version, {}
        else:
            days[version.of] = version
    return base, days
