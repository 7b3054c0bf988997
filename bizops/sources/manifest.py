"""Published folders whose contents change in one step.

New contents are written beside the old ones, into folders of their own, and a small manifest then
says which folders count.  Readers go by the newest manifest, so a write that fails, is killed or
is repeated leaves what was published before as it was, and several tables change together.  A
manifest is one new file, never overwritten, which works on object stores as well.  The contents that
the manifest before named stay, for readers that started with them; older ones are removed.

One writer at a time is assumed for a path.
"""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as pafs

from bizops.session import storage

_FOLDER = "_manifests"
KEEP = 2  # manifests, the current one included, whose folders stay


def new_folder(name: str = "data") -> str:
    """A folder below the published path that no other write uses."""
    return f"{name}/v={uuid.uuid4().hex}"


def _manifests(fs: pafs.FileSystem, path: str) -> list[str]:
    listed = fs.get_file_info(pafs.FileSelector(f"{path}/{_FOLDER}", allow_not_found=True))
    return sorted(i.path for i in listed if i.type == pafs.FileType.File and i.path.endswith(".json"))


def _read(fs: pafs.FileSystem, file: str) -> dict[str, str]:
    with fs.open_input_stream(file) as f:
        return json.loads(f.read().decode())


def current(path: str) -> dict[str, str]:
    """Entry -> folder (below ``path``) of the newest manifest; empty if nothing is published."""
    fs, root = storage(path)
    found = _manifests(fs, root)
    return _read(fs, found[-1]) if found else {}


def commit(path: str, entries: dict[str, str]) -> None:
    """Make ``entries`` the published contents of ``path``, then remove what no kept manifest names."""
    fs, root = storage(path)
    fs.create_dir(f"{root}/{_FOLDER}", recursive=True)
    before = _manifests(fs, root)
    number = int(before[-1].rsplit("/", 1)[1].split(".")[0]) + 1 if before else 1
    # Written under another name first: a name ending in .json is always a whole manifest.
    final = f"{root}/{_FOLDER}/{number:012d}.json"
    with fs.open_output_stream(f"{final}.tmp") as f:
        f.write(json.dumps(entries, sort_keys=True).encode())
    fs.move(f"{final}.tmp", final)
    kept = [*before, final][-KEEP:]
    named = {folder for file in kept for folder in _read(fs, file).values()}
    for file in [*before, final][:-KEEP]:
        for folder in set(_read(fs, file).values()) - named:
            if fs.get_file_info(f"{root}/{folder}").type == pafs.FileType.Directory:
                fs.delete_dir(f"{root}/{folder}")
        fs.delete_file(file)
