"""Names for internal columns that a caller's table does not have."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame


def sheltered(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns under numbered names of their own, so that no internal name meets them."""
    return [df[n].alias(f"own {i}") for i, n in enumerate(names)]


def restored(df: DataFrame, names: list[str], wanted: list[str] | None = None) -> list[Column]:
    """Sheltered columns under their names again, all or the wanted ones."""
    return [df[f"`own {i}`"].alias(n) for i, n in enumerate(names) if wanted is None or n in wanted]


def spare_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Each wanted name, with underscores in front until no column is called so."""
    used = {name.lower() for name in taken}
    found = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        found.append(name)
    return found
