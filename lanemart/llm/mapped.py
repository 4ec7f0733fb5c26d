"""Arrays in one file of the shared folder, read through a memory map.

A file is a line of JSON that names its arrays, then the arrays, each from a multiple of eight bytes on. It is written under
another name and renamed when it is whole, so a task that is run again replaces it and a reader never sees a part. On a
local path reading maps the file and only pages that are asked for are loaded; on a remote one the file is fetched once.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs


def _system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write(path: str, head: dict, arrays: dict[str, np.ndarray]) -> None:
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    line = json.dumps({"head": head, "arrays": places}).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    system, own = _system(path)
    system.create_dir(own.rpartition("/")[0], recursive=True)
    part = f"{own}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(line)
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).view(np.uint8).data)
            out.write(b"\0" * (-a.nbytes % 8))
    try:
        system.move(part, own)
    except OSError:
        if system.get_file_info(own).type != fs.FileType.File:
            raise
        system.delete_file(part)  # where renaming does not replace: an earlier run of the task wrote the same


def read(path: str) -> tuple[dict, dict[str, np.ndarray]]:
    system, own = _system(path)
    source = pa.memory_map(own) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(own)
    data = source.read_buffer()
    head, start = bytearray(), 0
    while not head.endswith(b"\n"):
        head += memoryview(data)[start : start + 8]
        start += 8
    found = json.loads(head)
    arrays = {n: np.frombuffer(data, np.dtype(kind), size, start + at) for n, (kind, size, at) in found["arrays"].items()}
    return found["head"], arrays


def delete(path: str) -> None:
    """Remove a file; arrays that are mapped from it stay readable until they are let go."""
    system, own = _system(path)
    system.delete_file(own)
