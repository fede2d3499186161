"""File access and the commit of files that tasks write.

Executors and driver reach the same folder through its URI. A task writes under a name
of its own and reports it; only reported files of the attempt that counted are listed
in a manifest, so a lost or repeated task leaves nothing that is read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import WriterCommitMessage


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: a list of plain dicts, one per file."""

    files: list


def write_manifest(uri: str, files: list[dict], overwrite: bool) -> None:
    """Adds one manifest; its rename is what makes the files count."""
    system, folder = open_folder(uri)
    system.create_dir(folder, recursive=True)
    old = [f.path for f in manifests(system, folder)] if overwrite else []
    name = f"{folder}/_manifest-{uuid.uuid4().hex}"
    with system.open_output_stream(name + ".new") as out:
        out.write(json.dumps(files).encode())
    system.move(name + ".new", name + ".json")
    for path in old:
        system.delete_file(path)


def manifests(system: fs.FileSystem, folder: str) -> list:
    listed = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return [f for f in listed if f.base_name.startswith("_manifest-") and f.base_name.endswith(".json")]


def committed(uri: str) -> list[dict]:
    """All files that committed writes have listed; their number is the number of write tasks, not of rows."""
    system, folder = open_folder(uri)
    out = []
    for found in manifests(system, folder):
        with system.open_input_stream(found.path) as f:
            out.extend(json.loads(f.read()))
    return out


def remove(uri: str, files: list[dict]) -> None:
    system, folder = open_folder(uri)
    for f in files:
        system.delete_file(f"{folder}/{f['name']}")
