"""Selection of sections by a specification such as ``1,4-6``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_spec(spec: str) -> list[int]:
    """Numbers in first-seen order without repeats; a malformed part or a falling range is an error."""
    out: dict[int, None] = {}
    for part in spec.split(","):
        m = re.fullmatch(r"\s*(\d+)(?:\s*-\s*(\d+))?\s*", part)
        if not m:
            raise ValueError(f"not a section number or range: {part!r}")
        first, last = int(m[1]), int(m[2] or m[1])
        if last < first:
            raise ValueError(f"range ends before it starts: {part!r}")
        out.update(dict.fromkeys(range(first, last + 1)))
    return list(out)


def select_by_spec(sections: DataFrame, number: str, spec: str) -> DataFrame:
    """The rows of the wanted numbers; a wanted number without a row is an error."""
    wanted = parse_spec(spec)
    chosen = sections.where(F.col(number).isin(wanted))
    found = {r[0] for r in chosen.select(number).distinct().collect()}  # no more than the numbers asked for
    if missing := [n for n in wanted if n not in found]:
        raise ValueError(f"no such section: {', '.join(map(str, missing))}")
    return chosen
