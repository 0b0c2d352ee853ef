"""File access of the Python data sources: any store that Arrow can open.

A path without a scheme, or with ``file:``, is local (a cluster needs shared
storage there); other URIs (HDFS, S3, GCS) go to Arrow's file systems.
"""

from __future__ import annotations

import os

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path, and the path inside it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def list_files(path: str, suffixes: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """``(path, size)`` of a file or of the files of a folder, in order; names that
    begin with ``_`` or ``.`` are not data."""
    store, at = open_store(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True, recursive=True))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File
                  and not f.base_name.startswith(("_", "."))
                  and not any(p.startswith(("_", ".")) for p in f.path[len(at):].split("/")[:-1] if p)
                  and (not suffixes or f.base_name.endswith(suffixes)))


def write_file(store: fs.FileSystem, path: str, data) -> None:
    """Write a file in a folder that exists: a task that is late to notice that its
    job failed cannot bring a deleted staging folder back."""
    with store.open_output_stream(path) as out:
        out.write(data)


def create_once(store: fs.FileSystem, path: str, data: bytes) -> bool:
    """Create a file with all its bytes unless it exists; whether it was created.
    Local files are linked into place; elsewhere a rename must refuse an existing
    target (as on HDFS)."""
    if store.get_file_info(path).type != fs.FileType.NotFound:
        return False
    part = f"{path}.{os.getpid()}-{os.urandom(6).hex()}"
    write_file(store, part, data)
    try:
        if isinstance(store, fs.LocalFileSystem):
            os.link(part, path)
        else:
            store.move(part, path)
            return True
    except OSError:
        return False
    finally:
        if store.get_file_info(part).type != fs.FileType.NotFound:
            store.delete_file(part)
    return True


def delete_folder(store: fs.FileSystem, path: str) -> None:
    if store.get_file_info(path).type != fs.FileType.NotFound:
        store.delete_dir(path)
