"""Plain versions of what the operators compute."""

import collections
import hashlib
import re
import zlib

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def lower(text):
    return (text or "").encode().lower().decode()


def words(text):
    return WORD.findall(text or "")


def base_spans(text):
    """(start, kind's place, end, kind) of the strong secrets of a text."""
    text, spans = text or "", []
    assign = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def span_text(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, n):
    w = words(lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def similar(sets, t):
    """Links of all pairs of sets that are similar enough."""
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    both = collections.Counter()
    for found in where.values():
        for k, a in enumerate(found):
            for b in found[k + 1 :]:
                both[a, b] += 1
    return [(a, b) for (a, b), c in both.items() if 100 * c >= t * (len(sets[a]) + len(sets[b]) - c)]


def near_duplicates(texts, n, t):
    """Component of each id of {id: text}."""
    sets = {i: shingles(x, n) for i, x in texts.items()}
    return components(texts, similar({i: s for i, s in sets.items() if s}, t)), sets


def item_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)) if w]


def contamination(texts, items):
    """(words, hit words, items) of each id."""
    windows = collections.defaultdict(set)
    for item, text in items.items():
        w = item_words(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    sizes, out = {len(g) for g in windows}, {}
    for i, text in texts.items():
        w, hit, found = item_words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= got
        out[i] = (len(w), len(hit), found)
    return out
