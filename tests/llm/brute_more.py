"""Plain versions of three more operators, for comparison only."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import xxhash

from tests.llm.brute import lower

WORD = r"[^\x20\x09-\x0D]"


def fingerprint(text: str | None) -> int:
    words = re.findall(WORD + "+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def print_groups(docs) -> dict:
    """doc id -> (fingerprint, smallest id reachable); ids are distinct."""
    prints = {i: fingerprint(t) for i, t in docs}
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (f"{prints[i]:016x}", root(i)) for i in ids}


def damage(rows):
    """Rows ``(conv, turn, role, text)`` after damage, in order, by conversation."""
    out: dict = {r[0]: [] for r in rows}
    space = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        role, text = space(role), space(text)
        draw = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        out[conv] += [(turn, role, text)] * (2 if draw == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: sorted(own, key=key) for c, own in out.items()}


GRAMMAR = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """``cost, audit, output`` by uniform-cost search over whole audits."""
    heap, seen = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if seen.get((at, state), (cost, audit)) < (cost, audit) or (at, state) in seen and seen[at, state] == (cost, audit):
            continue
        seen[at, state] = (cost, audit)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, out
        for role in "ua":
            if role in GRAMMAR[state]:
                name = {"u": "user", "a": "assistant"}[role]
                heapq.heappush(heap, (cost + 2, audit + "I", at, role, (*out, (name, ""))))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, out))
        if fault in ("blank", "duplicate"):
            continue
        extra = fault == "truncated"
        if role[:1] in GRAMMAR[state]:
            heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role[0], (*out, (role, text))))
        for new in "ua":
            if new in GRAMMAR[state]:
                name = {"u": "user", "a": "assistant"}[new]
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", at + 1, new, (*out, (name, text))))


def repairs(rows) -> dict:
    """conversation -> gaps, three fault counts, illegal, cost, audit, digest."""
    out = {}
    for conv, own in damage(rows).items():
        seen, faults, told = set(), [], []
        for _, role, text in own:
            visible = re.findall(WORD, text)
            fault = (
                "blank" if not visible else "duplicate" if (role, text) in seen
                else "truncated" if visible[-1] not in ".!?" else None
            )
            seen.add((role, text))
            faults.append(fault)
            told.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, new = cheapest(told)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in new).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def variants(docs) -> dict:
    """word -> (form, root, n, n_near, form_n)."""
    counts: dict = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    by: dict = {}
    for w in words:
        by.setdefault(w, set()).add(w)
        for k in range(len(w)):
            by.setdefault(w[:k] + w[k + 1 :], set()).add(w)
            by.setdefault((k, w[:k] + w[k + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            short = w[:k] + w[k + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
            near[w] |= by[k, short] - {w}
    forms = {}
    for w, n in words.items():
        best = min(((-words[x], x) for x in near[w]), default=None)
        forms[w] = best[1] if best and -best[0] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        form = forms[w]
        out[w] = (form, root, n, len(near[w]), words[form] if form else None)
    return out
