"""Plain, slow versions of the operators, written for clarity."""

from __future__ import annotations

import hashlib
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def groups(docs, k):
    """doc -> (number of shingles, smallest reachable doc), over all pairs."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {d: (len(sets[d]), root(d)) for d in ids}


def repeats(docs, length=100):
    """doc -> (bytes, removed, spans, digest of the rest)."""
    seen, out = set(), {}
    for d, t in sorted(docs):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+".replace(r"[\x20-]", "[ -]"))
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(re.fullmatch("0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])", p) for p in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def edit_distance(pattern, text):
    """Least edits from ``pattern`` to any part of ``text``."""
    above = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        row = [i]
        for j, t in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (p != t)))
        above = row
    return min(above)


NO_SPACES = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u9fff\uf900-\ufaff\U00020000-\U00033fff"
UNIT = re.compile(f"[{NO_SPACES}]|(?:(?![{NO_SPACES}\u3000-\u303f])[0-9a-z\x80-\U0010ffff])+")


def words(text):
    return UNIT.findall((text or "").lower())


def budgets(leaves: dict[tuple, int], weights: list[dict], budget: int, epochs: int) -> dict[tuple, int]:
    """Water-filling down a tree: ``leaves`` by path; siblings that can't take their share are filled and leave, until none is left."""
    if not weights:
        return {(): budget}
    names = {k[0] for k in leaves}
    cap = {n: epochs * sum(v for k, v in leaves.items() if k[0] == n) for n in names}
    w = {n: weights[0].get(n, 1) for n in names}
    given, open_ones, rest = {}, set(names), budget
    while open_ones:
        all_w = sum(w[n] for n in open_ones)
        filled = {n for n in open_ones if cap[n] * all_w <= rest * w[n]}
        if not filled:
            given |= {n: rest * w[n] // all_w for n in open_ones}
            break
        given |= {n: cap[n] for n in filled}
        rest -= sum(cap[n] for n in filled)
        open_ones -= filled
    return {(n, *below): b for n in names for below, b in budgets({k[1:]: v for k, v in leaves.items() if k[0] == n}, weights[1:], given[n], epochs).items()}
