"""Path and name functions as Columns; all split on both kinds of slashes."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed value: white space as str.strip() knows it
WHITE_CHARS = "".join(chr(i) for i in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_CHARS))


def norm_path(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def basename(c: Column) -> Column:
    return F.substring_index(norm_path(c), "/", -1)


def ext(c: Column) -> Column:
    """Last dot suffix, lower-cased; empty for names without one, for names that only begin with dots and for a trailing dot."""
    b = basename(c)
    last = F.substring_index(b, ".", -1)
    before = F.substring(b, F.lit(1), F.length(b) - F.length(last) - 1)
    real = (last != "") & (F.length(last) < F.length(b)) & (F.btrim(before, F.lit(".")) != "")
    return F.when(real, F.lower(F.concat(F.lit("."), last))).when(b.isNotNull(), "")


def ext_or(c: Column, label: str) -> Column:
    e = ext(c)
    return F.when(e == "", label).otherwise(e)


def stem(c: Column) -> Column:
    """Basename without its last suffix."""
    b = basename(c)
    return F.when(ext(c) == "", b).otherwise(F.substring(b, F.lit(1), F.length(b) - F.length(ext(c))))


def parent(c: Column) -> Column:
    p = norm_path(c)
    return F.when(F.instr(p, "/") > 0, F.substring(p, F.lit(1), F.length(p) - F.length(basename(c)) - 1)).when(p.isNotNull(), "")


def parts(c: Column) -> Column:
    """Directory parts without the basename and without empty parts."""
    return F.filter(F.split(parent(c), "/"), lambda x: x != "")


def relative_to(c: Column, root: Column) -> Column:
    """Path relative to ``root``; the whole path where it lies elsewhere."""
    p, r = norm_path(c), F.concat(F.rtrim(norm_path(root)), F.lit("/"))
    return F.when(F.startswith(p, r), F.substring(p, F.length(r) + 1, F.length(p))).otherwise(p)


def top_level(rel: Column) -> Column:
    return F.when(F.instr(rel, "/") > 0, F.substring_index(rel, "/", 1)).otherwise(F.lit("(root)"))


def relocate(c: Column, from_root: str, to_root: str) -> Column:
    """Path below one root moved below another; others unchanged."""
    p, a = norm_path(c), from_root.replace("\\", "/").rstrip("/") + "/"
    return F.when(F.startswith(p, F.lit(a)), F.concat(F.lit(to_root.replace("\\", "/").rstrip("/") + "/"), F.substring(p, F.lit(len(a) + 1), F.length(p)))).otherwise(p)


def glob_regex(pattern: str) -> str:
    """Case-insensitive whole-string regular expression of a shell pattern, for the JVM."""
    body = re.sub(r"\\Z$|\\z$", "", fnmatch.translate(pattern.replace("\\", "/")))
    body = re.sub(r"^\(\?s:(.*)\)$", r"\1", body)
    return f"(?is)^(?:{body})$"


def matches_globs(c: Column, patterns: list[str]) -> Column:
    """Whether basename or whole path matches any of the patterns."""
    rx = [glob_regex(p) for p in patterns if p]
    if not rx:
        return F.lit(False)
    tests = [F.rlike(t, F.lit(r)) for r in rx for t in (basename(c), norm_path(c))]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def glob_hits(c: Column, patterns: list[str]) -> Column:
    """All patterns that match, in the order given."""
    return F.array_compact(F.array(*(F.when(matches_globs(c, [p]), F.lit(p)) for p in patterns)))


def suffix_copy_of(c: Column) -> Column:
    """Path of the file that ``Name_N.ext`` would be a copy of; null for other names."""
    base = F.regexp_extract(stem(c), r"^(.+?)_(\d+)$", 1)
    return F.when(base != "", F.concat(parent(c), F.lit("/"), base, F.substring(basename(c), F.length(stem(c)) + 1, F.length(basename(c)))))
