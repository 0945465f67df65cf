"""Files that tasks write to, and read from, the shared folder by its URI."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs


def resolve(uri: str):
    """(file system, path) of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def written_whole(uri: str) -> Iterator:
    """A stream whose file appears under ``uri`` only when it is complete.

    A lost or repeated task leaves at most a file of another name; the last complete
    attempt wins, and all attempts write the same bytes.
    """
    fs, path = resolve(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.attempt"
    with fs.open_output_stream(attempt) as out:
        yield out
    fs.move(attempt, path)


def open_input(uri: str):
    """A seekable stream."""
    fs, path = resolve(uri)
    return fs.open_input_file(path)


def remove(uri: str) -> None:
    fs, path = resolve(uri)
    with contextlib.suppress(FileNotFoundError):
        fs.delete_file(path)
