"""Files of the shared folder as tasks see them: opened by their URI with Arrow, without a session."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a URI: file, s3 (s3a), gs, hdfs, abfs, or a plain path."""
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def data_files(uri: str) -> list[str]:
    """Sorted URIs of the parquet files directly below a folder; none when there is no such folder."""
    fs, path = file_system(uri)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f"{uri.rstrip('/')}/{f.base_name}" for f in found if f.type == pafs.FileType.File and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")))


def row_batches(uri: str, size: int, columns: list[str] | None = None) -> Iterator[pa.Table]:
    """The rows of a parquet file in order, so many at a time; the file is read as it is consumed."""
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        for batch in pq.ParquetFile(f).iter_batches(batch_size=size, columns=columns):
            yield pa.Table.from_batches([batch])


def copy_file(source: str, target: str, overwrite: bool = False) -> bool:
    """Copy one file through a temporary name; False when the target is there and stays."""
    from_fs, from_path = file_system(source)
    to_fs, to_path = file_system(target)
    if not overwrite and to_fs.get_file_info(to_path).type != pafs.FileType.NotFound:
        return False
    to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
    partial = f"{to_path}.{uuid.uuid4().hex}.tmp"
    with from_fs.open_input_stream(from_path, compression=None) as a, to_fs.open_output_stream(partial, compression=None) as b:
        while chunk := a.read(1 << 20):
            b.write(chunk)
    to_fs.move(partial, to_path)
    return True
