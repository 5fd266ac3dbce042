"""Small helpers that look at the head or the footer of one file, inside a task.

They use Arrow's file systems, so the same code opens local, HDFS, S3 and GCS paths. The
module travels with the task, so executors need no copy of this package.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER_SCHEMA = "path string, source_file string, columns array<string>, error string"
LINE_BYTES = 1 << 20  # the longest header line
COLUMNS = 20_000  # the CSV reader takes no more
ARCHIVES = (".gz", ".bz2", ".zst")
FOOTER_SCHEMA = (
    "path string, source_file string, file_size bigint, modified_at timestamp, row_count bigint, "
    "column_count int, row_groups int, compression string, columns array<string>, error string"
)
LISTING = (("path", pa.string()), ("file_size", pa.int64()), ("modified_at", pa.timestamp("us", "UTC")), ("is_folder", pa.bool_()))
LISTING_SCHEMA = "path string, file_size bigint, modified_at timestamp, is_folder boolean"
READABLE = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "abfs", "abfss")  # schemes that tasks can list
_FOOTER_TYPES = {
    "row_count": pa.int64(), "column_count": pa.int32(), "row_groups": pa.int32(), "compression": pa.string(),
    "columns": pa.list_(pa.string()), "error": pa.string(),
}


def _open(uri: str):
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    path = rest.lstrip("/")
    if scheme == "file":
        return fs.LocalFileSystem(), f"/{path}"
    return fs.FileSystem.from_uri(f"{scheme}://{quote(path, safe='/:@')}")  # a listing has plain paths


def _listed(uri: str, recursive: bool) -> list[tuple]:
    """(path, file_size, modified_at, is_folder) of what lies below a folder. Hidden names are left out, as readers do."""
    from pyarrow import fs

    files, folder = _open(uri)
    folder, root = folder.rstrip("/"), uri.rstrip("/")
    out = []
    for info in files.get_file_info(fs.FileSelector(folder, recursive=recursive)):
        inside = info.path[len(folder) :].strip("/")
        hidden = any(name[0] == "." or (name[0] == "_" and "=" not in name) for name in inside.split("/"))
        if not hidden and (info.type == fs.FileType.File or not recursive):
            out.append((f"{root}/{inside}", info.size or 0, info.mtime, info.type == fs.FileType.Directory))
    return out


def listing_batches(recursive: bool, per_batch: int = 10_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["path"].to_pylist():
                found = _listed(uri, recursive)
                for at in range(0, len(found), per_batch):
                    columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*found[at : at + per_batch]), LISTING)]
                    yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in LISTING])

    return run


def first_line(uri: str, chunk: int = 65536) -> str:
    """The first line of a text file. No more than ``LINE_BYTES`` are held; a compressed file is read to
    its end, piece by piece, since a broken one would end the scan that reads it later."""
    files, path = _open(uri)
    head = b""
    with files.open_input_stream(path) as stream:
        while b"\n" not in head and (more := stream.read(chunk)):
            head += more
            if len(head) > LINE_BYTES and b"\n" not in head:
                raise ValueError(f"no line break in the first {LINE_BYTES} bytes")
        while path.endswith(ARCHIVES) and stream.read(chunk):
            pass
    return head.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")


def _header(uri: str) -> tuple[list[str] | None, str | None]:
    """The columns of a file, or why they cannot be read: that is a finding and no failure."""
    try:
        columns = next(csv.reader([first_line(uri)]), [])
    except UnicodeDecodeError:
        return None, "header is not UTF-8"
    except Exception as problem:  # whatever is wrong with one file, the others go on
        return None, f"unreadable: {problem}"
    return (columns, None) if len(columns) <= COLUMNS else (None, f"more than {COLUMNS} columns")


def header_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_header(path.as_py()) for path in batch["path"]]
        batch = batch.append_column("columns", pa.array([f[0] for f in found], pa.list_(pa.string())))
        yield batch.append_column("error", pa.array([f[1] for f in found], pa.string()))


def _footer(uri: str) -> dict:
    import pyarrow.parquet as pq

    files, path = _open(uri)
    with files.open_input_file(path) as handle:
        meta = pq.ParquetFile(handle).metadata
    return {
        "row_count": meta.num_rows,
        "column_count": meta.num_columns,
        "row_groups": meta.num_row_groups,
        "compression": meta.row_group(0).column(0).compression if meta.num_row_groups else "unknown",
        "columns": [meta.schema.column(i).path for i in range(meta.num_columns)],
    }


def footer_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            try:
                found.append(_footer(path.as_py()))
            except Exception as problem:  # a corrupt file is a finding, not a failure
                found.append({"error": str(problem)})
        for name, kind in _FOOTER_TYPES.items():
            batch = batch.append_column(name, pa.array([f.get(name) for f in found], kind))
        yield batch
