"""Opening lake files inside tasks."""

from __future__ import annotations

import hashlib
import re
import uuid
from urllib.parse import quote

import pyarrow.fs

#: Bytes that a task holds of a file it copies or digests.
CHUNK = 8 << 20


def _located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a path as Spark spells it; local ones have a single slash or no scheme."""
    spelled = re.sub(r"^file:/(?!/)", "file:///", path if "://" in path or path.startswith("file:") else f"file://{path}")
    # Blanks and letters beyond ASCII are escaped; what is escaped already stays.
    return pyarrow.fs.FileSystem.from_uri(quote(spelled, safe="/:%?#[]@!$&'()*+,;=~"))


def open_in_task(path: str):
    """A file handle for reading."""
    filesystem, inner = _located(path)
    return filesystem.open_input_file(inner)


def write_in_task(path: str, body: bytes) -> None:
    """Write a small file, its folder included."""
    filesystem, inner = _located(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0])
    with filesystem.open_output_stream(inner) as handle:
        handle.write(body)


def copy_in_task(path: str, target: str, digest: str) -> str:
    """Copy a file in chunks and return its SHA-256; the target appears only if that is ``digest``.

    The copy grows under a name that ends in ``.part``, which inventories leave out.
    """
    filesystem, inner = _located(target)
    filesystem.create_dir(inner.rsplit("/", 1)[0])
    growing, taken = f"{inner}.{uuid.uuid4().hex}.part", hashlib.sha256()
    with open_in_task(path) as source, filesystem.open_output_stream(growing) as out:
        while chunk := source.read(CHUNK):
            taken.update(chunk)
            out.write(chunk)
    if taken.hexdigest() == digest:
        filesystem.move(growing, inner)
    else:
        filesystem.delete_file(growing)
    return taken.hexdigest()


def digest_in_task(path: str) -> str | None:
    """SHA-256 of a file, read in chunks; None where there is none."""
    filesystem, inner = _located(path)
    if filesystem.get_file_info(inner).type != pyarrow.fs.FileType.File:
        return None
    taken = hashlib.sha256()
    with filesystem.open_input_file(inner) as handle:
        while chunk := handle.read(CHUNK):
            taken.update(chunk)
    return taken.hexdigest()


def delete_in_task(path: str) -> None:
    """Delete a file if it is there."""
    filesystem, inner = _located(path)
    if filesystem.get_file_info(inner).type == pyarrow.fs.FileType.File:
        filesystem.delete_file(inner)
