"""Names, globs, paths and sizes, as functions of columns or plain strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_regex(glob: str) -> str:
    """A regular expression, for any case, of a glob with * ? [ ]."""
    parts = re.findall(r"\*|\?|\[!?[^\]]+\]|[^*?]", glob)
    return "(?is)^" + "".join(".*" if p == "*" else "." if p == "?" else p.replace("[!", "[^") if len(p) > 1 else re.escape(p) for p in parts) + "$"


def relative_path(from_dir: Column, to: Column) -> Column:
    """The way from a directory to a file, both absolute below one root."""
    a, b = F.split(from_dir, "/"), F.split(to, "/")
    steps = F.sequence(F.lit(0), F.least(F.size(a), F.size(b) - 1))
    shared = F.size(F.filter(steps, lambda k: (k > 0) & (F.slice(a, F.lit(1), k) == F.slice(b, F.lit(1), k))))
    return F.concat(F.repeat(F.lit("../"), F.size(a) - shared), F.array_join(F.slice(b, shared + 1, F.size(b)), "/"))


def readable_size(size: Column) -> Column:
    """Bytes in the largest unit that leaves a number of at least one, with one decimal from KB on."""
    units = ["KB", "MB", "GB", "TB"]
    out = F.concat(size.cast("string"), F.lit(" B"))
    for k, unit in enumerate(units, 1):
        out = F.when(size >= 1024**k, F.concat(F.format_number(size / 1024**k, 1), F.lit(f" {unit}"))).otherwise(out)
    return out
