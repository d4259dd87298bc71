"""Files of a shared store, read and written inside tasks as streams."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyarrow import fs


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it: ``file:/a``, ``/a`` or ``scheme://host/a``."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    return fs.FileSystem.from_uri(uri)
