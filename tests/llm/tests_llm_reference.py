"""Brute-force components, shared by the tests of this folder."""

import re


def brute_components(rows, k, num, den):
    """doc_id -> least doc_id of its component, by comparing all pairs of (doc_id, text)."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b:
                common = len(sets[a] & sets[b])
                if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: find(d) for d in sets}
