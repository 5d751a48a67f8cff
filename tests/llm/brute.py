"""Plain versions of the operators, over rows in memory."""

from __future__ import annotations

import hashlib
import re
import zlib


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def contamination(docs, items, window=10):
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    patterns = {}
    for item, text in items:
        found = words(text)
        n = min(window, len(found))
        for at in range(len(found) - n + 1 if n else 0):
            patterns.setdefault(tuple(found[at : at + n]), set()).add(item)
    lengths = {len(p) for p in patterns}
    rows = []
    for doc_id, text in docs:
        found, hit, seen = words(text), set(), set()
        for n in lengths:
            for at in range(len(found) - n + 1):
                own = patterns.get(tuple(found[at : at + n]))
                if own:
                    hit.update(range(at, at + n))
                    seen |= own
        names = sorted(str(x) for x in seen if x is not None)
        rows.append((doc_id, len(found), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return rows


def lines(docs, min_docs=3, characters=20):
    """doc_id, n_lines, n_dropped, kept_sha256."""
    blank = " \t\n\x0b\x0c\r"
    holders = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            key = lower(line.strip(blank))
            if len(key) >= characters and doc_id is not None:
                holders.setdefault(key, set()).add(doc_id)
    rows = []
    for doc_id, text in docs:
        split = (text or "").split("\n")
        stay = [
            x
            for x in split
            if doc_id is None or len(own := holders.get(lower(x.strip(blank)), ())) < min_docs or doc_id == max(own)
        ]
        rows.append((doc_id, len(split), len(split) - len(stay), sha("\n".join(stay))))
    return rows


def in_bucket(doc_id, buckets: int, bucket: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % buckets == bucket


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def near_duplicates(docs, percent=75):
    """doc_id, n_shingles, component_id, kept: all pairs compared."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    with_shingle = {}
    for n, (_, own) in enumerate(sets):
        for s in own:
            with_shingle.setdefault(s, []).append(n)
    pairs = {}
    for members in with_shingle.values():
        for x in members:
            for y in members:
                if x < y:
                    pairs[x, y] = pairs.get((x, y), 0) + 1
    for (x, y), shared in pairs.items():
        if shared * 100 >= percent * (len(sets[x][1]) + len(sets[y][1]) - shared):
            a, b = root(sets[x][0]), root(sets[y][0])
            parent[max(a, b)] = min(a, b)
    return [(i, len(own), root(i), root(i) == i) for i, own in sets]


def repeats(docs, length=200):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    times = {}
    for _, text in texts:
        for at in range(len(text) - length + 1):
            window = text[at : at + length]
            times[window] = times.get(window, 0) + 1
    rows = []
    for i, text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if times[text[at : at + length]] > 1:
                gone[at : at + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        rows.append((i, len(text), sum(gone), spans, sha(bytes(b for b, g in zip(text, gone, strict=True) if not g))))
    return rows


def base_spans(text):
    """(kind, start, end) of the fixed secret patterns, by start and then kind."""
    found = []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]
