"""Plain Python versions of the text operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    only = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m: all(int(p) <= 255 for p in m.split(".")),
        ),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(only(m)) <= 19 and luhn(only(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only(m)) <= 15),
    ]
    return [
        (kind, m.start(), m.end())
        for kind, pattern, fits in kinds
        for m in re.finditer(pattern, text)
        if fits(m.group())
    ]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingle_set(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_components(docs):
    """Sorted (doc_id, set size, smallest id of the component) of (doc_id, text) rows."""
    sets = [shingle_set(text) for _, text in docs]
    having = {}
    for k, s in enumerate(sets):
        for gram in s:
            having.setdefault(gram, []).append(k)
    common = {}
    for rows in having.values():
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    rows = ((doc_id, len(sets[k]), least.get(root(k))) for k, (doc_id, _) in enumerate(docs))
    return sorted(rows, key=str)
