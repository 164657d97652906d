"""Metadata parsed from file paths, as column expressions.

Paths from ``_metadata.file_path`` are URIs (percent-encoded); use
``decoded_path`` before parsing names out of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded_path(uri: Column) -> Column:
    """Percent-decode a file URI; a literal '+' stays a '+'."""
    return F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


# These run once per scanned line, so they use linear string functions
# (substring_index, length) rather than regular expressions.

def file_name(path: Column) -> Column:
    """Text after the last '/'."""
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """Name without its last extension. A leading dot or a trailing dot is not
    an extension ('.bashrc', 'a.' stay whole)."""
    name = file_name(path)
    ext = F.substring_index(name, ".", -1)
    keep = F.length(name) - F.length(ext) - F.lit(1)  # characters before the last dot
    has_ext = (F.instr(name, ".") > 0) & (F.length(ext) > 0) & (keep > 0)
    return F.when(has_ext, F.substring(name, F.lit(1), keep)).otherwise(name)


def parent_dir(path: Column) -> Column:
    """Name of the directory holding the file (null when there is none)."""
    return F.when(F.instr(path, "/") > 0,
                  F.substring_index(F.substring_index(path, "/", -2), "/", 1))


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def without_scheme(path: Column) -> Column:
    """``file:/a/b`` and ``s3a://bucket/a/b`` -> ``/a/b``."""
    return F.regexp_replace(path, _SCHEME, "")


def dir_below(path: Column, root: str) -> Column:
    """First directory below ``root`` (e.g. the subject folder); scheme and
    authority are ignored on both sides."""
    import re
    root = re.sub(_SCHEME, "", root).rstrip("/")
    bare = without_scheme(path)
    rest = F.when(bare.startswith(root + "/"), F.substring(bare, len(root) + 2, 1 << 30))
    parts = F.split(rest, "/")
    # only a directory: the last part is the file itself
    return F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(1)))


def split_part(text: Column, sep: str, index: int) -> Column:
    """1-based token of ``text`` split on literal ``sep``; negative counts from
    the end; null when the token does not exist."""
    return F.try_element_at(F.split(text, _quote(sep)), F.lit(index))


def token_count(text: Column, sep: str) -> Column:
    return F.size(F.split(text, _quote(sep)))


def trial_prefix(name: Column) -> Column:
    """Text before the first '-' of a file name (the trial number)."""
    return split_part(name, "-", 1)


def suffix_code(name: Column, width: int = 2) -> Column:
    """Last ``width`` characters of the name up to its first '.'."""
    head = split_part(name, ".", 1)
    return F.right(head, F.lit(width))


def dashed_metadata(name: Column) -> tuple[Column, Column, Column]:
    """Activity and volunteer from ``Accelerometer-Y-M-D-h-m-s-<activity>-<volunteer>.txt``.

    Returns ``(ok, activity, volunteer)``; ``ok`` is false when the name (with
    '.txt' removed) has fewer than nine dash-separated parts.
    """
    bare = F.replace(name, F.lit(".txt"), F.lit(""))
    ok = token_count(bare, "-") >= 9
    return ok, split_part(bare, "-", 8), split_part(bare, "-", 9)


def underscored_ids(stem: Column) -> tuple[Column, Column]:
    """``(sid, trial)`` from a stem such as ``HGD_v2_walking_03_05``: the last
    token is the trial, the one before it the subject; both integers."""
    trial = split_part(stem, "_", -1).try_cast("int")
    sid = split_part(stem, "_", -2).try_cast("int")
    return sid, trial


def _quote(sep: str) -> str:
    import re
    return re.escape(sep)
