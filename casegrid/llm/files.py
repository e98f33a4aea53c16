"""Files in the folder that driver and executors share, from inside Spark tasks.

Paths are URIs as Hadoop writes them (``file:/x``, ``file:///x``, ``hdfs://...``, a bare
local path). A file is written under a name of its attempt and then moved to its final
name, so a repeated or speculative task leaves one whole file, with the same content.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

from pyarrow import fs


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    local = re.match(r"(?:file:(?://)?)?(/.*)", uri)
    if local:
        return fs.LocalFileSystem(), local[1]
    return fs.FileSystem.from_uri(uri)


@contextmanager
def written(folder: str, name: str) -> Iterator[BinaryIO]:
    """A new file ``folder/name``, there only once it is whole."""
    system, base = file_system(folder)
    system.create_dir(base, recursive=True)
    mine = f"{base}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(mine) as out:
        yield out
    system.move(mine, f"{base}/{name}")


@contextmanager
def opened(uri: str) -> Iterator[BinaryIO]:
    """A file for reads at any place."""
    system, path = file_system(uri)
    with system.open_input_file(path) as f:
        yield f


def read_at(f: BinaryIO, start: int, length: int) -> bytes:
    f.seek(start)
    data = f.read(length)
    if len(data) != length:
        raise ValueError(f"{length} bytes wanted at {start}, {len(data)} there")
    return data
