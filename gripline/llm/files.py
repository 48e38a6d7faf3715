"""Files that tasks write themselves: temporary names, renames and manifests."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder in the shared store."""
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))


@contextmanager
def committed(folder: str, name: str) -> Iterator:
    """A stream to a temporary name that becomes `name` once all is written.

    A task that fails leaves only its temporary file; one that runs twice writes the same bytes and the last rename wins.
    """
    store, path = place(folder)
    store.create_dir(path, recursive=True)
    temporary = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        yield out
    store.move(temporary, f"{path}/{name}")


def reader(folder: str, name: str):
    store, path = place(folder)
    return store.open_input_file(f"{path}/{name}")
