"""Column-name rules, applied on the driver while the plan is built."""

from __future__ import annotations

import re
from collections.abc import Sequence


def clean_name(name: str) -> str:
    """Lower-case ASCII letters and digits, everything else folded to single inner underscores."""
    return "_".join(re.findall(r"[A-Za-z0-9]+", name)).lower()


def clean_names(names: Sequence[str]) -> list[str]:
    """Clean all names; an empty or repeated result is an error, not a silent merge."""
    cleaned = [clean_name(n) for n in names]
    empty = [n for n, c in zip(names, cleaned) if not c]
    if empty:
        raise ValueError(f"no letters or digits in column names {empty}")
    clashes = sorted({c for c in cleaned if cleaned.count(c) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return cleaned
