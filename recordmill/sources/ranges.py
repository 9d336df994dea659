"""Files as driver and tasks read them: listed once, pinned to what they were, opened for ranges.

Paths without a scheme and file: paths are mounted files. Other schemes (s3:, gs:, hdfs:, mock:) go
through ``pyarrow.fs``, which every task opens for itself.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import urlsplit

import pyarrow.fs as pafs


class ChangedError(ValueError):
    """A file is no longer the one that was listed."""


@dataclass(frozen=True)
class Pinned:
    """A file at the size and version (time of change) that it had when it was listed."""

    path: str
    size: int
    version: str


def mounted(path: str) -> str | None:
    """The local path, or null for another store."""
    scheme = urlsplit(path).scheme
    if scheme in ("", "file"):
        return path.removeprefix("file://") if scheme else path
    return None


def _hidden(path: str) -> bool:
    return os.path.basename(path).startswith(("_", "."))


def stamp(info) -> str:
    """Size and time of change as one text."""
    return str(info.mtime_ns if info.mtime_ns is not None else "")


def listed(path: str) -> list[Pinned]:
    """The files of a folder, or those that a pattern (mounted files) or an exact path names, by name.
    Hidden ones are left out; a path that is not there is an error."""
    local = mounted(path)
    if local is not None:
        found = glob.glob(os.path.join(local, "*")) if os.path.isdir(local) else glob.glob(local)
        if not found and not glob.has_magic(local) and not os.path.exists(local):
            raise FileNotFoundError(path)
        out = []
        for p in sorted(found):
            if os.path.isfile(p) and not _hidden(p):
                s = os.stat(p)
                out.append(Pinned(p, s.st_size, str(s.st_mtime_ns)))
        return out
    fs, inner = pafs.FileSystem.from_uri(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else f"{urlsplit(path).scheme}://"
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    infos = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(inner))
    return sorted((Pinned(prefix + i.path, i.size, stamp(i)) for i in infos if i.type == pafs.FileType.File and not _hidden(i.path)), key=lambda p: p.path)


@contextmanager
def opened(file: Pinned) -> Iterator[BinaryIO]:
    """The file, if it is still what was listed."""
    local = mounted(file.path)
    if local is not None:
        with open(local, "rb") as f:
            now = os.fstat(f.fileno())
            if (now.st_size, str(now.st_mtime_ns)) != (file.size, file.version):
                raise ChangedError(f"{file.path} has changed since it was planned")
            yield f
        return
    fs, inner = pafs.FileSystem.from_uri(file.path)
    info = fs.get_file_info(inner)
    if (info.size, stamp(info)) != (file.size, file.version):
        raise ChangedError(f"{file.path} has changed since it was planned")
    with fs.open_input_file(inner) as f:
        yield f
