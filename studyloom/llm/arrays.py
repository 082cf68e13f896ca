"""Files of arrays in the folder that all executors share, written by tasks and memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np


def opened(path: str, mode: str):
    """A file of the shared folder, whose store pyarrow opens (a local path, hdfs, s3, gs)."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if mode == "w":
        store.create_dir(os.path.dirname(name), recursive=True)
        return store.open_output_stream(name)
    return store.open_input_file(name)


def mapped(path: str) -> np.ndarray:
    """The shared file itself where it is a local one; else an unnamed local copy, which goes with the worker."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return np.memmap(url.path, dtype=np.uint8, mode="r")
    with opened(path, "r") as f, tempfile.TemporaryFile() as copy:
        while block := f.read(1 << 24):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, dtype=np.uint8, mode="r")


def write(path: str, parts: list[bytes]) -> str:
    """A new file below a path. Its name is its own, and only names that finished tasks hand on are ever read, so a
    task that runs twice does no harm."""
    name = f"{path}/{uuid.uuid4().hex}"
    with opened(name, "w") as f:
        for data in parts:
            f.write(data)
    return name
