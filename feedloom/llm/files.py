"""Files that tasks write and read themselves, on any file system Arrow knows."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; a plain path is local."""
    if ":" not in uri.split("/", 1)[0]:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    if not rest.startswith("//"):  # file:/x
        uri = f"{scheme}://{rest}"
    return pafs.FileSystem.from_uri(uri)


def read_folder(uri: str) -> pa.Table | None:
    """All rows of the parquet files in a folder; None if the folder is not there."""
    fs, root = open_fs(uri)
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    tables = [pq.read_table(f.path, filesystem=fs) for f in found if f.extension == "parquet"]
    return pa.concat_tables(tables) if tables else None
