"""Files that tasks write into a shared folder.

A task writes under a name no other attempt uses and reports it in its rows; only reported
files are ever read, so attempts that were lost or repeated leave nothing but unread files.
Any file system pyarrow knows will do: the folder is the one Spark's checkpoints use.
"""

from __future__ import annotations

from typing import BinaryIO

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri)
    return system, path.rstrip("/")


def create(uri: str) -> BinaryIO:
    """A new file; its folder is made where the file system has folders."""
    system, path = place(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)  # the name may end in .gz: the bytes are ours


def open_seekable(uri: str) -> BinaryIO:
    system, path = place(uri)
    return system.open_input_file(path)
