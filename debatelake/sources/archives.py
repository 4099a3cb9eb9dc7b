"""Tar archives: XML members only, nested archives too, none outside the root."""

from __future__ import annotations

import io
import posixpath
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_ARCHIVE = re.compile(r"\.(taz|tar|tar\.gz|tgz)$", re.I)
_YEAR = re.compile(r"^(19|20)\d{2}/")


def safe_name(name: str) -> str | None:
    """A member's path without a leading year; null if it leaves the root."""
    path = posixpath.normpath(name)
    if path.startswith(("/", "..")) or path in (".", ""):
        return None
    return _YEAR.sub("", path)


def members(data: bytes) -> Iterator[tuple[str, bytes]]:
    """XML members of an archive and of the archives in it; a broken one yields what could be read."""
    try:
        with tarfile.open(fileobj=io.BytesIO(data)) as tar:
            for m in tar:
                name = safe_name(m.name)
                if not m.isfile() or name is None:
                    continue
                content = tar.extractfile(m).read()
                if _ARCHIVE.search(name):
                    yield from members(content)
                elif name.lower().endswith(".xml"):
                    yield name, content
    except (tarfile.TarError, EOFError):
        return


def extract(archives: DataFrame) -> DataFrame:
    """Rows (archive, path, content) from rows (path, content), member by member."""

    def run(batches):
        for batch in batches:
            for archive, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                for name, content in members(data.as_py() or b""):
                    yield pa.RecordBatch.from_pylist([{"archive": archive, "path": name, "content": content}])

    return archives.select("path", "content").mapInArrow(run, "archive string, path string, content binary")
