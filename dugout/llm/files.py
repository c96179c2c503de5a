"""Files that tasks write and read in the shared folder, through pyarrow's file systems (local, HDFS, S3, GCS)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs as pafs


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


@contextmanager
def published(uri: str) -> Iterator:
    """A writable stream that becomes ``uri`` only when it is closed without error.

    A task that is run again (lost executor, speculation) replaces the file by one of equal content."""
    store, path = open_store(uri)
    if isinstance(store, pafs.S3FileSystem) or type(store).__name__ == "GcsFileSystem":
        with store.open_output_stream(path) as out:       # object stores show an object when it is complete
            yield out
        return
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with store.open_output_stream(part) as out:
            yield out
        try:
            store.move(part, path)
        except OSError:                                    # HDFS does not move onto an existing file
            store.delete_file(path)
            store.move(part, path)
    except BaseException:
        if store.get_file_info(part).type != pafs.FileType.NotFound:
            store.delete_file(part)
        raise
