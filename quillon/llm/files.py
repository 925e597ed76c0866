"""Files that tasks write side by side in a folder all executors share.

A task writes to a name of its own attempt and reports it in its output rows. Only the rows of the attempt that Spark
commits reach the manifest, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

from pyspark import TaskContext


def attempt_name(stem: str, number: int, ending: str) -> str:
    task = TaskContext.get()
    return f"{stem}-{task.partitionId():06d}-{number:06d}-{task.taskAttemptId()}.{ending}"


def make_folder(folder: str) -> None:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)


def write_bytes(folder: str, name: str, content: bytes) -> None:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(content)
