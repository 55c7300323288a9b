"""Files in the shared folder that the cluster names in spark.checkpoint.dir.

A task writes a file under a name of its own attempt and returns that name in
a row; only names in rows that Spark committed are read. A lost or repeated
attempt leaves a file that nobody reads.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def put(folder: str, name: str, data: bytes) -> str:
    """Writes ``data`` to a new file of ``folder``; returns the file's place."""
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    own = f"{name}-{uuid.uuid4().hex[:12]}"
    with store.open_output_stream(f"{path}/{own}") as out:
        out.write(data)
    return f"{folder}/{own}"


def get(uri: str) -> bytes:
    store, path = _open(uri)
    with store.open_input_file(path) as f:
        return f.read()
