"""Plain versions of the operators, for tables small enough to compare everything."""

from __future__ import annotations

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_set(text: str | None, width: int = 5) -> set:
    words = WORD.findall((text or "").encode().translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def smallest_reachable(nodes: list, links: list[tuple]) -> dict:
    """Component of every place in ``nodes``: the smallest name its links reach."""
    best = list(nodes)
    while True:
        before = list(best)
        for i, j in links:
            best[i] = best[j] = min(best[i], best[j])
        if before == best:
            return best


def kept_lines(rows: list[tuple], min_words: int) -> dict:
    """``{(doc_id, text): (lines kept, lines removed)}`` by comparing every run with every earlier one."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0, _md5(r[1])))
    seen: set = set()
    out = {}
    for doc in docs:
        lines = doc[1].split("\n")
        gone = set()
        for start in range(len(lines)):
            for end in range(start + 1, len(lines) + 1):
                run = tuple(lines[start:end])
                if sum(len(WORD.findall(x.encode())) for x in run) >= min_words:
                    if run in seen:
                        gone |= set(range(start, end))
                    seen.add(run)
        out[doc] = ([x for i, x in enumerate(lines) if i not in gone], len(gone))
    return out


def _md5(text: str) -> str:
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()
