"""Folders that count only once they are complete, and logs of such folders.

A folder is complete when its commit mark is there, written after all its files.  The mark is a file of
its own, so nothing depends on renames or on a committer's settings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

MARK = "_COMMITTED"


def _hadoop(spark: SparkSession, path: str):
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, in order; none where there is no such path."""
    files, named = _hadoop(spark, path)
    if not files.exists(named):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(named) if s.isDirectory())


def commit(spark: SparkSession, path: str, body: str = "") -> None:
    """Mark a folder as complete; ``body`` goes into the mark."""
    files, named = _hadoop(spark, f"{path}/{MARK}")
    out = files.create(named, True)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()


def commit_note(spark: SparkSession, path: str) -> str | None:
    """What a folder's mark says; None where the folder is not complete."""
    files, named = _hadoop(spark, f"{path}/{MARK}")
    if not files.exists(named):
        return None
    opened = files.open(named)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def forget(spark: SparkSession, path: str) -> None:
    """Delete a folder.  Its mark goes first: what is left of it counts no more."""
    files, mark = _hadoop(spark, f"{path}/{MARK}")
    files.delete(mark, False)
    files.delete(_hadoop(spark, path)[1], True)


@dataclass(frozen=True)
class Generation:
    """A complete folder of a log: its number, and the names that a base stands for."""

    name: str
    replaces: frozenset[str]

    @property
    def number(self) -> int:
        return int(self.name.split("-")[1])

    @property
    def is_base(self) -> bool:
        return self.name.startswith("base-")


def generations(spark: SparkSession, path: str) -> list[Generation]:
    """The complete generations of a log that count, oldest first.

    A base replaces the generations that its mark names.  One that was written beside it and is not named
    still counts, whatever its number.
    """
    found = []
    for name in child_folders(spark, path):
        note = commit_note(spark, f"{path}/{name}") if name.startswith(("base-", "part-")) else None
        if note is not None:
            found.append(Generation(name, frozenset(note.split())))
    gone = frozenset().union(*(g.replaces for g in found))
    return sorted((g for g in found if g.name not in gone), key=lambda g: (g.number, not g.is_base, g.name))


def next_number(spark: SparkSession, path: str) -> int:
    """Beyond every generation, complete or torn."""
    names = [name for name in child_folders(spark, path) if name.startswith(("base-", "part-"))]
    return max((int(name.split("-")[1]) for name in names), default=0) + 1
