"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def near_components(rows, words, percent):
    """``{id: (set size, component)}`` from all pairs that share a shingle."""
    sets = {i: shingle_set(t, words) for i, t in rows}
    by, root = {}, {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in sets.items():
        common = {}
        for x in s:
            for j in by[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def personal(text):
    """The base spans as (start, order, end, kind)."""
    out = []
    for k, (kind, (pattern, valid)) in enumerate(PII.items()):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(m.group())]
    return sorted(out)


def span_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans).encode()).hexdigest()


def crc(data):
    return zlib.crc32(data)
