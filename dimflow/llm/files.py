"""Files of own formats in a folder that all executors share.

A task writes files under names of its own making and returns what is in them; Spark commits those
rows with the rest of the task's output. So a task that is run again leaves a file that nothing names, and
readers only ever open what a finished task has named.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _resolved(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> str:
    store, path = _resolved(uri)
    store.create_dir(path, recursive=True)
    return uri


def fresh_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    """A new file to write bytes to."""
    store, path = _resolved(uri)
    return store.open_output_stream(path, compression=None)  # a name like .zst must not compress again


def read(uri: str, offset: int, length: int) -> bytes:
    """``length`` bytes from ``offset`` on; a negative offset counts from the end."""
    store, path = _resolved(uri)
    with store.open_input_file(path) as source:
        return source.read_at(length, offset if offset >= 0 else source.size() + offset)
