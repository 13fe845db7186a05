"""Folders that driver and executors share, opened without Spark: what the data sources read and write."""

from __future__ import annotations

import json

from pyarrow import fs


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path inside it."""
    bare = path.removeprefix("file:")
    if bare.startswith("/"):
        return fs.LocalFileSystem(), "/" + bare.strip("/")
    system, inside = fs.FileSystem.from_uri(path)
    return system, inside.rstrip("/")


def list_files(path: str, recursive: bool = True) -> list[fs.FileInfo]:
    """Files of a folder by path; an absent folder has none."""
    system, folder = open_folder(path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=recursive))
    return sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path)


def read_bytes(path: str) -> bytes:
    system, inside = open_folder(path)
    with system.open_input_stream(inside) as stream:
        return stream.read()


def write_bytes(path: str, data: bytes) -> None:
    system, inside = open_folder(path)
    system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inside) as stream:
        stream.write(data)


def publish_json(path: str, temporary: str, value: object) -> None:
    """Write under a temporary name, then rename: readers see the old value or the new one."""
    write_bytes(temporary, json.dumps(value, ensure_ascii=False, sort_keys=True).encode())
    system, target = open_folder(path)
    system.create_dir(target.rsplit("/", 1)[0], recursive=True)
    system.move(open_folder(temporary)[1], target)
