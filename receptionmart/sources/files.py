"""Files read as streams inside tasks, where no row may hold a whole file."""

from __future__ import annotations

import csv
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs

CHUNK_BYTES = 4 << 20
# Names under which Spark and the file system library know the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_stream(path: str):
    """A file as Spark names it, opened through its own file system and read from the beginning in parts."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/") if colon else path)
    authority, _, key = rest.lstrip("/").partition("/")
    system, root = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{authority}/")
    return system.open_input_stream(f"{root.rstrip('/')}/{key}")


def sha256_of(path: str, chunk: int = CHUNK_BYTES) -> str:
    digest = hashlib.sha256()
    with open_stream(path) as stream:
        while part := stream.read(chunk):
            digest.update(part)
    return digest.hexdigest()


def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (path, bytes) with the digest of each file."""
    for batch in batches:
        yield batch.assign(sha256=[sha256_of(p) for p in batch["path"]])


def header_of(path: str) -> list[str]:
    """Column names in the first line of a CSV file; none if it is empty."""
    with open_stream(path) as stream, io.TextIOWrapper(stream, encoding="utf-8-sig", newline="") as lines:
        return next(csv.reader([lines.readline().rstrip("\r\n")]), [])


def with_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (path, header, error); a file that can't be read has an error and no header."""
    for batch in batches:
        rows = []
        for path in batch["path"]:
            try:
                rows.append((path, header_of(path), None))
            except (OSError, UnicodeError, csv.Error) as err:
                rows.append((path, None, f"{type(err).__name__}: {err}"))
        yield pd.DataFrame(rows, columns=["path", "header", "error"])
