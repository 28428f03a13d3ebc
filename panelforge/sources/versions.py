"""Folders whose content changes as a whole: versions that are never altered, and numbered pointers to them.

    folder/versions/<name>/     what a version holds
    folder/pointers/<number>    JSON: the version that counts from here on, and facts about it
    folder/WRITER               there while somebody writes

A pointer is made only when its version is complete, by a create that fails if the number is taken; readers take the highest pointer that can be read. So a reader
sees a whole version or the one before it, and a writer that stops midway leaves the old state. The version before the current one
stays, since readers may still be at it; what neither points to is deleted by the next writer.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..schema import PanelError

#: Seconds after which a writer's mark counts as left by one that has died.
STALE = 24 * 3600


@dataclass(frozen=True)
class Version:
    """A version that a pointer names: its number, its path and its facts."""

    number: int
    path: str
    facts: dict


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)).rstrip("/"))

    def names(self, part: str) -> list[str]:
        return [f.getPath().getName() for f in self.files.listStatus(self.at(part))] if self.files.exists(self.at(part)) else []

    def write(self, text: str, *parts: str) -> bool:
        """Makes a file with this text; false if it is there already."""
        try:
            out = self.files.create(self.at(*parts), False)
        except Exception as e:
            if self.files.exists(self.at(*parts)):
                return False
            raise e
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, *parts: str) -> dict | None:
        """The JSON of a file; null if it is missing, or was left before it was written."""
        if not self.files.exists(self.at(*parts)):
            return None
        stream = self.files.open(self.at(*parts))
        try:
            # a few hundred bytes
            return json.loads(bytes(stream.readAllBytes()).decode())
        except ValueError:
            return None
        finally:
            stream.close()

    def pointers(self) -> list[Version]:
        """All pointers that can be read, the newest first."""
        found = []
        for number in sorted((int(n) for n in self.names("pointers") if n.isdigit()), reverse=True):
            facts = self.read("pointers", f"{number:09d}")
            if facts:
                found.append(Version(number, f"{self.path}/versions/{facts['version']}", facts))
        return found

    def current(self) -> Version | None:
        """The version that counts now."""
        return next(iter(self.pointers()), None)

    @contextmanager
    def writing(self, stale: float = STALE) -> Iterator[Writer]:
        """A writer, the only one; another one's mark is an error unless it is stale."""
        mark = {"writer": uuid.uuid4().hex, "since": time.time()}
        if not self.write(json.dumps(mark), "WRITER"):
            other = self.read("WRITER") or {}
            if time.time() - other.get("since", time.time()) < stale:
                raise PanelError(f"somebody else writes {self.path}")
            self.files.delete(self.at("WRITER"), False)
            if not self.write(json.dumps(mark), "WRITER"):
                raise PanelError(f"somebody else writes {self.path}")
        try:
            own = Writer(self)
            own.clean()
            yield own
        finally:
            if (self.read("WRITER") or {}).get("writer") == mark["writer"]:
                self.files.delete(self.at("WRITER"), False)


class Writer:
    """What Folder.writing gives: a path for a new version, and the commit that makes it count."""

    def __init__(self, folder: Folder):
        self.folder, self.name = folder, uuid.uuid4().hex
        self.before = folder.current()
        taken = [int(n) for n in folder.names("pointers") if n.isdigit()]
        self.number = max(taken, default=0) + 1

    @property
    def path(self) -> str:
        return f"{self.folder.path}/versions/{self.name}"

    def commit(self, **facts) -> Version:
        """From now on the version at path counts. A number that somebody else has taken meanwhile is an error, and nothing changes."""
        own = {"version": self.name, **facts}
        if not self.folder.write(json.dumps(own), "pointers", f"{self.number:09d}"):
            raise PanelError(f"{self.folder.path} was written by somebody else meanwhile")
        return Version(self.number, self.path, own)

    def clean(self) -> None:
        """Deletes versions that neither the current nor the last pointer names, and older pointers."""
        pointers = self.folder.pointers()
        kept = {p.path.rpartition("/")[2] for p in pointers[:2]}
        for name in self.folder.names("versions"):
            if name not in kept:
                self.folder.files.delete(self.folder.at("versions", name), True)
        for p in pointers[2:]:
            self.folder.files.delete(self.folder.at("pointers", f"{p.number:09d}"), False)
