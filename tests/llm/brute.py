"""Plain single-text versions of what the operators promise, for comparison only."""

from __future__ import annotations

import hashlib
import re

BLANK = r"[\x20\x09-\x0D]"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def listed(spans, kinds) -> str:
    order = {k: n for n, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]])))


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    "("
    + "|".join(map(either_case, ("password", "passwd", "secret", "token")))
    + "|"
    + either_case("api") + "_?" + either_case("key")
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secret_base(text: str):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]


def luhn(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(d if k % 2 == 0 else doubled[int(d)]) for k, d in enumerate(digits[::-1])) % 10 == 0


def personal_base(text: str):
    out = [
        ("email", *m.span())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def bench_words(text: str | None):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def leaks(text: str | None, items, window: int = 10):
    """``n_words, n_hit, ids`` of one text against ``items`` (id, text)."""
    words, hit, found = bench_words(text), set(), set()
    for item, own in items:
        own = bench_words(own)
        n = min(window, len(own))
        if not n:
            continue
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def shingles(text: str | None, n: int = 5):
    words = [w for w in re.split(BLANK + "+", lower(text or "")) if w]
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(docs, percent: int = 75):
    """doc id -> smallest id reachable over pairs with enough overlap; ids are distinct."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by: dict = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    near = {(a, b) for own in by.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    for a, b in near:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeats(docs, size: int = 200):
    """doc id -> (bytes, removed, spans, digest of what is left)."""
    raw = {i: (t or "").encode() for i, t in docs}
    seen: dict[bytes, int] = {}
    for b in raw.values():
        for k in range(len(b) - size + 1):
            seen[b[k : k + size]] = seen.get(b[k : k + size], 0) + 1
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        left = bytes(c for c, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out
