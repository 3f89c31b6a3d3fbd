"""Path columns: the tree is encoded in strings ("./a/b/" + "name")."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The root directory and the name of the root entry.
ROOT_DIR = "./"
ROOT_NAME = "."


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def full_path(dirname="dirname", filename="filename") -> Column:
    return F.concat(_c(dirname), _c(filename))


def root_of(dirname="dirname") -> Column:
    """First path component below ``./`` ('' for the root directory itself)."""
    d = _c(dirname)
    return F.substring_index(F.substring(d, F.lit(3), F.length(d)), "/", 1)


def under(dirname, prefix: str, case_insensitive: bool = False) -> Column:
    """Literal prefix test (the reference's ``LIKE 'dir%'``), pushed to the scan."""
    c = _c(dirname)
    if case_insensitive:
        return F.lower(c).startswith(prefix.lower())
    return c.startswith(prefix)


def ancestor_dirs(dirname="dirname") -> Column:
    """Array of (parent, name, depth) for every directory on the way to ``dirname``.

    ``./a/b/`` gives (./, a, 1) and (./a/, b, 2); ``./`` gives an empty array.
    """
    d = _c(dirname)
    parts = F.split(d, "/")            # ['.', 'a', 'b', '']
    n = F.size(parts) - 2
    return F.when(n <= 0, F.array().cast("array<struct<parent:string,name:string,depth:int>>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
            F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")).alias("parent"),
            F.element_at(parts, i + 1).alias("name"),
            i.alias("depth"))))


def prefix_dirs(path) -> Column:
    """All directory prefixes (ending in '/') of a relative path: ``a/b/c`` gives a/, a/b/."""
    p = _c(path)
    parts = F.split(p, "/")
    n = F.size(parts) - 1
    return F.when(n <= 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))))


def breadcrumbs(path) -> Column:
    """All prefixes of a path in order: a, a/b, a/b/c."""
    p = _c(path)
    parts = F.split(p, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def split_path(path) -> tuple[Column, Column]:
    """Greedy split into (dirname with trailing '/', leaf name)."""
    p = _c(path)
    return F.regexp_extract(p, r"^(.*/)[^/]*$", 1), F.regexp_extract(p, r"([^/]*)$", 1)


def normalize_path(path) -> tuple[Column, Column]:
    """Ensure the ``./`` prefix, drop one trailing '/', split into (dirname, filename).

    The root itself becomes (``./``, ``.``).
    """
    p = _c(path)
    p = F.regexp_replace(p, r"/$", "")
    p = F.when(p.startswith("./") | (p == F.lit(".")), p).otherwise(F.concat(F.lit("./"), p))
    return split_path(p)


def glob_to_regex(mask: str) -> str:
    out = []
    for ch in mask:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        else:
            out.append(re.escape(ch))
    return "".join(out)


def masks_regex(masks: list[str]) -> str:
    """Whole-name, case-insensitive alternation of glob masks."""
    return "(?i)^(" + "|".join(glob_to_regex(m) for m in masks) + ")$"
