"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def ngram_components(rows, k, numerator, denominator):
    sets = {d: shingles(t, k) for d, t in rows}
    firsts, holders = {}, defaultdict(list)
    links = []
    for d in sorted(sets):
        f = frozenset(sets[d])
        if f and firsts.setdefault(f, d) != d:
            links.append((firsts[f], d))
    for f, d in firsts.items():
        count = defaultdict(int)
        for s in f:
            for e in holders[s]:
                count[e] += 1
            holders[s].append(d)
        for e, n in count.items():
            if denominator * n >= numerator * (len(f) + len(sets[e]) - n):
                links.append((e, d))
    found = components(sets, links)
    return {(d, len(sets[d]), found[d]) for d in sets}


def item_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination(documents, benchmark, span=13, share=20):
    import hashlib

    windows = defaultdict(set)
    for item, text in benchmark:
        w = item_words(text)
        n = min(len(w), span)
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(k) for k in windows}
    out = set()
    for d, text in documents:
        w = item_words(text)
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    items |= found
        out.add((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and share * len(hit) >= len(w)))
    return out


def base_spans(text):
    text = text or ""
    out = []
    for kind, pattern, keep in (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m.group(2)) >= 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 16),
    ):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if keep(m)]
    return sorted(out, key=lambda x: (x[0], ("assign", "access", "hex").index(x[1])))


ALPHABETS = ("0123456789", "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")


def random_spans(text, fdr=1e-4, reject=1e-3):
    """Runs of one alphabet, character by character; the tests by their textbook sums; Benjamini-Hochberg by trying every cut."""
    import math

    prose = dict(zip("abcdefghijklmnopqrstuvwxyz", (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1), strict=True))
    free = [True] * len(text)
    for s, _, e in base_spans(text):
        free[s:e] = [False] * (e - s)
    sign = [f and (c.isascii() and (c.isalnum() or c in "+/_=-")) for c, f in zip(text, free, strict=True)]
    found, i = set(), 0
    while i < len(text):
        if not sign[i]:
            i += 1
            continue
        j = i
        while j < len(text) and sign[j]:
            j += 1
        last = j
        while last > i and text[last - 1] == "=":
            last -= 1
        if j - i >= 20:
            for alphabet in ALPHABETS:
                a = i
                while a < last:
                    b = a
                    while b < last and text[b] in alphabet:
                        b += 1
                    if b - a >= 20:
                        found.add((a, b, j if b == last else b))
                    a = max(b, a + 1)
        i = j
    tried = []
    for s, end, e in sorted(found):
        value = text[s:end]
        if not any(c.isdigit() for c in value) and (value.islower() or value.isupper() or value[1:].islower()):
            continue
        alphabet = next((a for a in ALPHABETS if set(value) <= set(a)), None)
        if alphabet is None:
            continue
        n, k = len(value), len(alphabet)
        expected = n / k
        chi = sum((value.count(c) - expected) ** 2 / expected for c in alphabet)
        z = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
        p_chi = 0.5 * math.erfc(z / math.sqrt(2))
        x = [alphabet.index(c) for c in value]
        high = ["ab"[v >= k // 2] for v in x]
        ups, downs = high.count("b"), high.count("a")
        if ups and downs:
            mean = 2 * ups * downs / n + 1
            var = (mean - 1) * (mean - 2) / (n - 1)
            runs = len([1 for p, q in zip(["", *high], high) if p != q])
            p_runs = math.erfc(abs(runs - mean) / math.sqrt(var) / math.sqrt(2)) if var > 0 else 1.0
        else:
            p_runs = 2.0 ** (1 - n)
        m = sum(x) / n
        spread = sum((v - m) ** 2 for v in x)
        p_serial = math.erfc(abs(sum((p - m) * (q - m) for p, q in zip(x, x[1:])) / spread * math.sqrt(n)) / math.sqrt(2)) if spread else 0.0
        ratio = 1.0
        for c in value:
            said = 0.01 if c.isdigit() else 0.85 * prose[c.lower()] / 1002 * (0.9 if c.islower() else 0.1) if c.isalpha() else 0.0125
            ratio *= said * k
        tried.append((min(ratio, 1.0) if min(p_chi, p_runs, p_serial) >= reject else 1.0, s, e))
    mean = sum(e - s for _, s, e in tried) / max(len(tried), 1)
    weighted = [(p * mean / (e - s), s, e) for p, s, e in tried]
    cut = max((p for p, _, _ in weighted if p <= fdr * sum(q <= p for q, _, _ in weighted) / len(weighted)), default=-1.0)
    taken = sorted(((s, e) for p, s, e in weighted if p <= cut), key=lambda x: (x[0], -x[1]))
    return [x for i, x in enumerate(taken) if all(x[1] > y[1] for y in taken[:i])]
