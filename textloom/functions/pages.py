"""Plain functions on the pages of one document."""

from __future__ import annotations

import math


def repeated(pages: list[list[str]], share: float, least: int) -> set[str]:
    """The lines, without white space at their ends, that stand on at least `share` of the pages, if these are `least` or more. A page's lines are gone through once; a line remembers the last page it was counted on."""
    if len(pages) < least:
        return set()
    seen: dict[str, tuple[int, int]] = {}
    for number, page in enumerate(pages, 1):
        for line in page:
            last, n = seen.get(line.strip(), (0, 0))
            if last < number:
                seen[line.strip()] = number, n + 1
    enough = max(1, math.ceil(share * len(pages) - 1e-9))
    return {line for line, (_, n) in seen.items() if line and n >= enough}


def drop_repeated(pages: list[str], share: float = 0.6, least: int = 3) -> list[str]:
    """The pages without their repeated lines."""
    split = [p.split("\n") for p in pages]
    gone = repeated(split, share, least)
    return ["\n".join(x for x in lines if x.strip() not in gone) for lines in split] if gone else pages
