"""Small files in a shared folder: manifests, published whole or not at all."""

from __future__ import annotations

import json
import re
import uuid

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or of a URI."""
    return fs.FileSystem.from_uri(path) if re.match(r"^\w+:/", path) else (fs.LocalFileSystem(), path)


def numbered(path: str, suffix: str = ".json") -> list[int]:
    """Numbers of the files ``<number><suffix>`` in a folder, ascending; none if it is missing."""
    store, root = open_store(path)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    names = (re.fullmatch(rf"(\d+){re.escape(suffix)}", f.base_name) for f in found)
    return sorted(int(m[1]) for m in names if m)


def exists(path: str) -> bool:
    store, root = open_store(path)
    return store.get_file_info(root).type != fs.FileType.NotFound


def read_json(path: str):
    store, root = open_store(path)
    with store.open_input_stream(root) as stream:
        return json.loads(stream.read())


def publish_json(path: str, value) -> None:
    """Write a file that appears under its name only when it is complete."""
    store, root = open_store(path)
    store.create_dir(root.rsplit("/", 1)[0], recursive=True)
    hidden = f"{root}.{uuid.uuid4().hex}.new"
    with store.open_output_stream(hidden) as out:
        out.write(json.dumps(value).encode())
    store.move(hidden, root)


def remove(path: str) -> None:
    """Delete a file or folder; nothing if it is not there."""
    store, root = open_store(path)
    kind = store.get_file_info(root).type
    if kind == fs.FileType.Directory:
        store.delete_dir(root)
    elif kind == fs.FileType.File:
        store.delete_file(root)
