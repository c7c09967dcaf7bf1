"""Plain single-process versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=13):
    """docs: (id, text); items: (id, text) -> one tuple per document."""
    starts = {}
    for item, text in items:
        ws = WORD.findall((text or "").translate(UP))
        size = min(window, len(ws))
        for i in range(len(ws) - size + 1 if ws else 0):
            starts.setdefault(size, {}).setdefault(tuple(ws[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        ws = WORD.findall((text or "").translate(UP))
        hit, found = set(), set()
        for size, windows in starts.items():
            for i in range(len(ws) - size + 1):
                items_here = windows.get(tuple(ws[i : i + size]))
                if items_here:
                    hit.update(range(i, i + size))
                    found |= items_here
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(ws), len(hit), len(names), sha(",".join(names)), len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return out


def simhash(text, shingle=3):
    import xxhash

    ws = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UP))
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + shingle]).encode(), 42) for i in range(max(1, len(ws) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_components(docs, radius=2):
    """docs: (id, text) -> (id, fingerprint, smallest id reachable)."""
    fps = [simhash(t) for _, t in docs]
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    least = {}
    for (doc, _), f in zip(docs, fps, strict=True):
        r = find(f)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [(doc, f"{f:016x}", least.get(find(f))) for (doc, _), f in zip(docs, fps, strict=True)]
