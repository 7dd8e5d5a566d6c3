"""Column references and names."""

from __future__ import annotations

from collections.abc import Iterable

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    """The column called exactly `name`, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def standard_name(name: str) -> str:
    """Lower case, spaces as underscores, nothing else."""
    return name.lower().replace(" ", "_")


def repeated(names: Iterable[str]) -> list[str]:
    """Names that occur more than once when case is ignored, sorted."""
    seen: dict[str, int] = {}
    for name in names:
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
    return sorted(name for name, n in seen.items() if n > 1)


def unused(name: str, taken: Iterable[str]) -> str:
    """`name`, lengthened until it is none of `taken`; Spark ignores case in names."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name
