"""Plain versions that the operators are held against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near_duplicate_components(texts: dict, width: int, threshold: int = 80) -> dict:
    """Smallest reachable id of every document, by counting all shared shingles."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    representative: dict = {}
    for i in sorted(sets):
        representative.setdefault(sets[i], i)
    holders = defaultdict(list)
    for i in representative.values():
        for s in sets[i]:
            holders[s].append(i)
    common = Counter()
    for ids in holders.values():
        for x, a in enumerate(ids):
            for b in ids[x + 1:]:
                common[min(a, b), max(a, b)] += 1
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = [(i, representative[s]) for i, s in sets.items() if s]
    links += [(a, b) for (a, b), n in common.items() if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n)]
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def rule_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, duplicate lines, and words in repeated three-word windows."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind: str, found: str) -> bool:
    digits = [int(c) for c in re.findall("[0-9]", found)]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def personal_spans(text: str | None) -> list[tuple[str, int, int]]:
    return [(kind, m.start(), m.end()) for kind, p in _PATTERNS.items() for m in re.finditer(p, text or "") if _passes(kind, m[0])]


def contained_items(documents: dict, items: dict, width: int = 5, threshold: int = 80) -> set:
    def sets(text):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}

    wanted = {i: sets(t) for i, t in items.items()}
    held = {i: sets(t) for i, t in documents.items()}
    return {
        (d, i, len(w), len(w & h)) for d, h in held.items() for i, w in wanted.items()
        if w and 100 * len(w & h) >= threshold * len(w)
    }
