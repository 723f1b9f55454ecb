"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)).encode()).hexdigest()


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return out


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def private(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def contaminated(docs, items, window=10):
    """doc_id -> (n_words, n_hit, item ids)."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[k : k + window])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    ids |= found
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """source -> target, by resharing again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s] + 1e-9}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, near):
    """Row index -> smallest id reachable; rows: (id, x)."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near(rows[i][1], rows[j][1]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return [min(least[find(i)], default=None) for i in range(len(rows))]


def removed_lines(docs):
    """Row -> removed line numbers; docs: (doc_id, text) without repeats."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    lines = []
    for r, (d, t) in enumerate(docs):
        for i, x in enumerate((t or "").split("\n")):
            w = word.findall(x.lower())
            if w:
                lines.append((d is None, d or 0, i, r, frozenset(w)))
    lines.sort(key=lambda x: x[:4])
    by_word, out = defaultdict(list), defaultdict(list)
    for k, (_, _, i, r, w) in enumerate(lines):
        shared = Counter(j for x in w for j in by_word[x])
        if any(5 * n >= 4 * (len(w) + len(lines[j][4]) - n) for j, n in shared.items()):
            out[r].append(i)
        for x in w:
            by_word[x].append(k)
    return out
