"""Files that tasks write to the shared folder, one or more each, and a manifest of those that count."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from .shared import file_system, local_uri


@contextlib.contextmanager
def new_file(folder: str, name: str) -> Iterator[tuple[object, str]]:
    """(open stream, final URI). The file gets its final name only when it is whole.

    The name is unique to the attempt, so a task that runs twice leaves two files, of
    which the manifest names the one whose attempt counted.
    """
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    unique = f"{uuid.uuid4().hex[:12]}-{name}"
    with fs.open_output_stream(f"{path}/.{unique}.part") as out:
        yield out, f"{local_uri(folder)}/{unique}"
    fs.move(f"{path}/.{unique}.part", f"{path}/{unique}")


def open_file(uri: str):
    """A seekable binary file."""
    fs, path = file_system(uri)
    return fs.open_input_file(path)
