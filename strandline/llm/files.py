"""Files in the shared folder, read and written inside tasks through Arrow's file systems."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager


def opened(uri: str):
    """(file system, path) of a file or folder URI; a bare path is a local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@contextmanager
def new_file(folder: str, name: str) -> Iterator:
    """A stream to ``folder/name``.  The file gets its name when it is whole, so a task that is run
    again replaces it and one that dies leaves nothing that is read."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        yield out
    system.move(draft, f"{path}/{name}")
