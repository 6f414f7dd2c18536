"""Names, sizes and times of the driver: organism names, file names, formats."""

from __future__ import annotations

import re
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are no species, and endings of file names.
_NOT_SPECIES = {"data", "bold", "samples", "sequences"}
_SUFFIXES = ("_bold_data", "_sequences", "_samples", "_data", "_bold", "_annotated", "_metadata")


def organism_of_path(path: str) -> str:
    """First two words of the file's stem, joined by '_', unless the second is a generic word."""
    parts = Path(path).stem.split("_")
    return parts[0] if len(parts) < 2 or parts[1].lower() in _NOT_SPECIES else "_".join(parts[:2])


def organism_column(path: Column) -> Column:
    """P23 in a plan: what ``organism_of_path`` gives for a column of paths."""
    base = F.element_at(F.split(path, "/"), -1)
    parts = F.split(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""), "_")
    second = F.get(parts, 1)
    alone = second.isNull() | F.lower(second).isin(sorted(_NOT_SPECIES))
    return F.when(alone, F.get(parts, 0)).otherwise(F.concat_ws("_", F.get(parts, 0), second))


def organism_of_stem(path: str) -> str:
    """The stem without one of the known suffixes."""
    stem = Path(path).stem
    for suffix in _SUFFIXES:
        if stem.lower().endswith(suffix) and len(stem) > len(suffix):
            return stem[: -len(suffix)]
    return stem


def safe_name(name: str) -> str:
    """Letters, digits, '.', '_' and '-' only; never empty."""
    return re.sub(r"_+", "_", re.sub(r"[^\w.\-]", "_", name)).strip("_. ") or "unnamed"


def safe_path(folder: str, name: str, extension: str | None = None) -> Path:
    base = Path(folder).resolve()
    name = safe_name(name) + (f".{extension.lstrip('.')}" if extension else "")
    found = (base / name).resolve()
    if base not in found.parents:
        raise ValueError(f"{name} leaves {folder}")
    return found


def elapsed(seconds: float) -> str:
    if seconds < 60:
        return f"{seconds:.1f}s"
    minutes, rest = divmod(int(seconds), 60)
    hours, minutes = divmod(minutes, 60)
    return f"{hours}h {minutes}m {rest}s" if hours else f"{minutes}m {rest}s"


def file_size(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024 or unit == "TB":
            return f"{n:.1f} {unit}"
        n /= 1024
    raise AssertionError


def timestamp() -> str:
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def version_of(text: str) -> tuple[int, ...] | None:
    found = re.search(r"(\d+(?:\.\d+)+|\bv?\d+\b)", text)
    return tuple(int(x) for x in found[0].lstrip("v").split(".")) if found else None


def compare_versions(a: str, b: str) -> int:
    x, y = version_of(a) or (), version_of(b) or ()
    n = max(len(x), len(y))
    x, y = x + (0,) * (n - len(x)), y + (0,) * (n - len(y))
    return (x > y) - (x < y)


def tool_available(name: str, min_version: str | None = None) -> bool:
    """Whether an external program is on the path (and new enough, if asked)."""
    import shutil
    import subprocess

    if not shutil.which(name):
        return False
    if not min_version:
        return True
    said = subprocess.run([name, "--version"], capture_output=True, text=True, timeout=30)
    return compare_versions(said.stdout + said.stderr, min_version) >= 0
