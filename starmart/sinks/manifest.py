"""Which folders hold the current tables of a file warehouse.

Manifests are numbered files, each a whole list of tables and folders; the one
with the highest number counts. A manifest appears by a rename, which is whole
or has not happened, so readers see the tables of one publication or of the
one before, never a part of each.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import SparkSession

from starmart.storage import delete, names_in, read_text, write_new

FOLDER = "_manifests"
_DIGITS = 12


class PublishConflict(RuntimeError):
    """Another job published first."""


@dataclass(frozen=True)
class Manifests:
    spark: SparkSession
    root: str

    @property
    def folder(self) -> str:
        return f"{self.root}/{FOLDER}"

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:0{_DIGITS}d}.json"

    def numbers(self) -> list[int]:
        """Ascending. Drafts begin with a dot and have no number."""
        stems = [name.removesuffix(".json") for name in names_in(self.spark, self.folder)]
        return sorted(int(s) for s in stems if len(s) == _DIGITS and s.isdigit())

    def tables(self, number: int) -> dict[str, str]:
        """Folders by table, below the root; none before the first publication."""
        return json.loads(read_text(self.spark, self._file(number)))["tables"] if number else {}

    def newest(self) -> int:
        return max(self.numbers(), default=0)

    def publish(
        self, folders: dict[str, str], without: Collection[str] = (), after: int | None = None
    ) -> int:
        """Puts ``folders`` in the place of the tables of these names, leaves out
        those of ``without`` and keeps the others. If another job publishes in
        between, its tables are kept and these go on top, as if this job had run
        after it; where that would be wrong, ``after`` is the manifest that the
        folders were made from, and any later one raises."""
        while True:
            number = self.newest()
            if after not in (None, number):
                raise PublishConflict(f"{self.root} is at {number}, no longer at {after}")
            kept = {t: f for t, f in self.tables(number).items() if t not in without}
            text = json.dumps({"tables": dict(sorted((kept | folders).items()))}, indent=1)
            draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"
            if write_new(self.spark, self._file(number + 1), text, draft):
                return number + 1

    def expire(self, keep: int) -> list[str]:
        """Removes all but the newest ``keep`` manifests. Returns the folders
        that only they named."""
        numbers = self.numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        used = {folder for n in kept for folder in self.tables(n).values()}
        gone = {folder for n in old for folder in self.tables(n).values()} - used
        for number in old:
            delete(self.spark, self._file(number))
        return sorted(gone)
