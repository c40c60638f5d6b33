"""Files in the shared working folder, written and read by tasks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def fresh(folder: str, part: int, ending: str) -> str:
    """A name that no other attempt of the task uses; a lost attempt leaves a file nobody names."""
    return f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.{ending}"


def make_folder(uri: str) -> None:
    system, path = place(uri)
    system.create_dir(path, recursive=True)


def write(uri: str, chunks: Iterable[bytes]) -> int:
    system, path = place(uri)
    size = 0
    with system.open_output_stream(path, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    return size


def reader(uri: str) -> pa.NativeFile:
    """For range reads: seek, then read."""
    system, path = place(uri)
    return system.open_input_file(path)


def read_range(file: pa.NativeFile, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)
