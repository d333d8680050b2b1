"""Small files that tasks and the driver read and write themselves, by URI or path."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs as pafs


def open_storage(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path within it; a bare path is a mounted folder."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_json(folder: str, name: str, value: object) -> None:
    """Write a small JSON file so that it appears as a whole or not at all, in place of an older one."""
    system, top = open_storage(folder)
    system.create_dir(top, recursive=True)
    draft = f"{top}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        out.write(json.dumps(value).encode())
    system.move(draft, f"{top}/{name}")


def read_json(folder: str, name: str) -> object | None:
    """The value of a JSON file, or None where there is no such file."""
    system, top = open_storage(folder)
    if system.get_file_info(f"{top}/{name}").type != pafs.FileType.File:
        return None
    with system.open_input_stream(f"{top}/{name}", compression=None) as source:
        return json.loads(source.read())
