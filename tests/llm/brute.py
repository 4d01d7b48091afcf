"""Plain versions of the corpus operators for small tables."""

import collections
import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


def personal(text):
    out = []
    for order, (kind, pattern) in enumerate((("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                                             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                                             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = WORDS.findall(text)
    n = len(words)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def grams(text, n=5):
    words = WORDS.findall(text)
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(n))))


def near(docs, threshold=0.8):
    """doc_id -> (class_id, text_class, copies, n_links), for unique ids."""
    by_set = collections.defaultdict(list)
    for k, t in docs:
        g = grams(t)
        by_set[g or k].append(k)
    first = {key: min(ids) for key, ids in by_set.items()}
    real = [(first[g], g) for g in by_set if isinstance(g, frozenset)]
    parent = {k: k for k in first.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for i, (a, x) in enumerate(real):
        for b, y in real[:i]:
            if len(x & y) >= threshold * len(x | y):
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {k: (find(first[key]), first[key], len(ids), links[first[key]]) for key, ids in by_set.items() for k in ids}


def repeats(docs, span=50):
    """[(doc_id, n_bytes, n_removed, n_spans, kept)] with null ids after all others."""
    key = lambda k: float("inf") if k is None else k
    least = {}
    for k, t in docs:
        b = t.encode()
        for i in range(len(b) - span + 1):
            s = b[i:i + span]
            least[s] = min(least.get(s, float("inf")), key(k))
    out = []
    for k, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if least[b[i:i + span]] < key(k):
                gone[i:i + span] = b"\1" * span
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((k, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return out
