"""Files in the shared folder that tasks read and write themselves.

The folder must be one that ``pyarrow.fs`` reaches from the driver and from every executor.
"""

from __future__ import annotations


def opened(folder: str):
    """File system and path of a folder or file URI."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def put(path: str, content: bytes) -> None:
    where, name = opened(path)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    with where.open_output_stream(name) as out:
        out.write(content)


def get(path: str):
    """The content of a file as a buffer."""
    where, name = opened(path)
    with where.open_input_file(name) as stored:
        return stored.read_buffer()
