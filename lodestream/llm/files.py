"""Binary files in the shared folder, from tasks: any store that pyarrow opens by URI (file, hdfs, s3, gcs)."""

from __future__ import annotations

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes, attempt: str) -> None:
    """Writes under a name of the task attempt, then moves: a repeated or lost task leaves the whole file or none."""
    store, path = _at(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(f"{path}.{attempt}") as f:
        f.write(data)
    if store.get_file_info(path).type != fs.FileType.NotFound:  # of an attempt that was lost after it had written
        store.delete_file(path)
    store.move(f"{path}.{attempt}", path)


def read_file(uri: str, start: int = 0, size: int | None = None) -> bytes:
    store, path = _at(uri)
    with store.open_input_file(path) as f:
        if start:
            f.seek(start)
        return f.read(size) if size is not None else f.read()
