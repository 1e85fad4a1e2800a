"""File-name helpers (X6-X10), all native expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the extension of a base name as Python's os.path.splitext returns it
# (leading dots do not start an extension; 'a.' -> '.', '.bashrc' -> '', 'x.tar.gz' -> '.gz').
EXTENSION_PATTERN = r"(?s)^.*?[^.].*?(\.[^.]*)$"

# Format-name aliases for extensions an image writer knows under another name.
FORMAT_ALIASES = {"JPG": "JPEG", "TIF": "TIFF"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(path: str | Column) -> Column:
    """Last path component."""
    return F.substring_index(_col(path), "/", -1)


def extension(name: str | Column) -> Column:
    """Extension of the last path component including the dot, '' when there is none."""
    return F.regexp_extract(basename(name), EXTENSION_PATTERN, 1)


def format_name(ext: str | Column) -> Column:
    """'.jpg' -> 'JPEG', '.png' -> 'PNG' (X9)."""
    bare = F.upper(F.trim(_col(ext), F.lit(".")))
    out = bare
    for k, v in FORMAT_ALIASES.items():
        out = F.when(bare == F.lit(k), F.lit(v)).otherwise(out)
    return out


def parse_extensions(spec: str | Iterable[str]) -> list[str]:
    """'jpg, .PNG' -> ['.jpg', '.png'].  Set membership, not the substring test."""
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    out = []
    for item in items:
        e = item.strip().lower()
        if not e:
            continue
        out.append(e if e.startswith(".") else "." + e)
    return sorted(set(out))


def has_extension(ext: str | Column, allowed: str | Iterable[str]) -> Column:
    """Lower-cased extension is one of ``allowed``."""
    return F.lower(_col(ext)).isin(parse_extensions(allowed))
