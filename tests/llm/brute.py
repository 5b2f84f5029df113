"""Plain-Python versions of the operators, for comparison on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate(_UPPER)


def shingles(text, n=3):
    words = SPACED.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def components(docs, n=3, percent=90):
    """[(doc_id, n_shingles, component_id)]; docs: list of (doc_id, text)."""
    sets = [shingles(t, n) for _, t in docs]
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in at[x] if j < i)
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)]


def contamination(docs, items, window=13):
    """[(doc_id, n_words, n_hit, n_items, sha256, contaminated)]"""
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lower(text))
        n = min(len(words), window)
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if own := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        bad = bool(hit) and 20 * len(hit) >= len(words)
        out.append((doc, len(words), len(hit), len(found), digest, bad))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    n = len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    chars = sum(map(len, words))
    return n, chars, symbols, len(lines) - len(set(lines)), len(repeated), failed


RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def url_verdict(url, rules=RULES):
    """(host, path, rule, verdict or None)"""
    host = path = ""
    if url is not None and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        host, path = lower(host), slash + tail
    best = None
    for h, p, verdict in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return (host, path, *(best or (None, None)))


def copies(docs, weights, seed=17):
    """{(doc_id, copy)} of mixing; docs: list of (doc_id, text, source)."""
    chars = Counter()
    for _, text, source in docs:
        chars[source] += len(text or "")
    used = [s for s in chars if chars[s]]
    weight = sum(weights.get(s, 1.0) for s in used)
    total = sum(chars.values())
    out = Counter()
    for doc, _, source in docs:
        if not chars[source]:
            continue
        rate = weights.get(source, 1.0) / weight * total / chars[source]
        u = int(hashlib.md5(f"{seed}:{doc}".encode()).hexdigest()[:13], 16) / 2**52
        k, below = 0, math.exp(-rate)
        term = below
        while u >= below:
            k += 1
            term *= rate / k
            below += term
        out.update((doc, c) for c in range(k))
    return out
