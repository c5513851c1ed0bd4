"""Small files in the shared folder, on the file system that its path names."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; Hadoop's ``file:/x`` is a local path."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), os.path.abspath(path)) if "://" not in path else fs.FileSystem.from_uri(path)


def read_bytes(path: str) -> bytes | None:
    """Content of a file, None where there is none."""
    at, name = located(path)
    if at.get_file_info(name).type != fs.FileType.File:
        return None
    with at.open_input_file(name) as f:
        return f.read()


def read_text(path: str) -> str | None:
    data = read_bytes(path)
    return None if data is None else data.decode("utf-8")


def write_text(path: str, text: str) -> None:
    """Replace a file at once: readers see the old or the new content."""
    at, name = located(path)
    at.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{uuid.uuid4().hex}.part"
    with at.open_output_stream(part) as out:
        out.write(text.encode("utf-8"))
    at.move(part, name)


def names_in(folder: str) -> list[str]:
    """Names of the files and folders in a folder; none where it is missing."""
    at, name = located(folder)
    return sorted(f.base_name for f in at.get_file_info(fs.FileSelector(name, allow_not_found=True)))


def remove(path: str) -> None:
    at, name = located(path)
    kind = at.get_file_info(name).type
    if kind == fs.FileType.Directory:
        at.delete_dir(name)
    elif kind == fs.FileType.File:
        at.delete_file(name)


def move(path: str, target: str) -> str:
    """Move a file; a taken name gets ``_1``, ``_2`` and so on.  The new path."""
    at, name = located(path)
    _, to = located(target)
    at.create_dir(os.path.dirname(to), recursive=True)
    stem, extension = os.path.splitext(to)
    free, k = to, 0
    while at.get_file_info(free).type != fs.FileType.NotFound:
        k += 1
        free = f"{stem}_{k}{extension}"
    at.move(name, free)
    return free


def copy(path: str, target: str) -> str:
    at, name = located(path)
    _, to = located(target)
    at.create_dir(os.path.dirname(to), recursive=True)
    at.copy_file(name, to)
    return to


def inside(root: str, path: str) -> str:
    """The path, if it lies below the root; a guard before anything is removed."""
    _, a = located(root)
    _, b = located(path)
    a, b = os.path.normpath(a), os.path.normpath(b)
    if b == a or not b.startswith(a + os.sep):
        raise ValueError(f"{path} does not lie below {root}")
    return path
