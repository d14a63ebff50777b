"""Binary files in the shared folder, written and read by tasks through pyarrow's file systems.

Every attempt of a task writes files of its own, under new names; only the names that the
successful attempt returns get into the written manifest.  A lost executor or a repeated
task leaves unlisted files behind, never a wrong result."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^[a-z][a-z0-9+.-]*:", path, re.I):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def new_file(folder: str, suffix: str) -> tuple[str, object]:
    """A new file in ``folder`` (made if needed): its path and an output stream."""
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    system, at = _open(path)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    return path, system.open_output_stream(at, compression=None)


def open_file(path: str):
    """A seekable input file."""
    system, at = _open(path)
    return system.open_input_file(at)
