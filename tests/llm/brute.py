"""Straightforward versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return [w.decode() for w in _WORD.findall((text or "").encode())]


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def simhash(text):
    w = words(lower_az(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=2):
    """Component number of each fingerprint."""
    fps = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(fps ^ fps[i]) <= radius)[0]:
            parent[find(i)] = find(int(j))
    return [find(i) for i in range(len(fps))]


def op1(docs):
    fps = [simhash(t) for _, t in docs]
    comp = components(fps)
    low = {}
    for (d, _), c in zip(docs, comp):
        if d is not None:
            low[c] = min(low.get(c, d), d)
    return [(d, f"{f:016x}", low.get(c)) for (d, _), f, c in zip(docs, fps, comp)]


def op2(docs, window=13):
    first = {}
    key = lambda d: 2 ** 63 - 1 if d is None else d
    for d, t in sorted(docs, key=lambda r: key(r[0])):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), key(d))
    out = []
    for d, t in docs:
        w, gone = words(t), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key(d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def op6(docs, window=200):
    count = Counter()
    data = [(d, (t or "").encode()) for d, t in docs]
    for _, b in data:
        count.update(b[i:i + window] for i in range(len(b) - window + 1))
    out = []
    for d, b in data:
        runs = []
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + window
                else:
                    runs.append([i, i + window])
        edge = [0, *(x for r in runs for x in r), len(b)]
        out.append((d, len(b), sum(e - s for s, e in runs), len(runs),
                    sha(b"".join(b[s:e] for s, e in zip(edge[::2], edge[1::2])))))
    return out


def item_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(text))


def op7(docs, items, window=10):
    grams = {}
    for i, t in items:
        w = item_words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add(i)
    lengths = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w, hit, found = item_words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return out


def op5(docs):
    out = []
    for d, t in docs:
        text, w = t or "", words(t)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        count, cover = Counter(windows), set()
        for i, x in enumerate(windows):
            if count[x] > 1:
                cover.update(range(i, i + 5))
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover),
                    len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def op4(docs):
    out = []
    for d, t in docs:
        spans = base_spans(t)
        count = Counter(s[3] for s in spans)
        out.append((d, *(count[k] for k, _ in PATTERNS), sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans))))
    return out


def op8(rows):
    talks = {}
    for conv, turn, role, text in set(rows):   # a row without an id stands alone
        talks.setdefault((conv, None if conv is not None else (turn, role, text)), []).append((turn, role, text))
    low = lambda x: (x is not None, x if x is not None else 0)
    txt = lambda x: (x is not None, x or "")
    talks = {c: tuple((r, t) for _, r, t in sorted(v, key=lambda x: (low(x[0]), txt(x[1]), txt(x[2]))))
             for c, v in talks.items()}
    prefixes = {v[:k] for v in talks.values() for k in range(1, len(v))}
    seen, kept = set(), []
    for conv, alone in sorted(talks, key=lambda c: (c[0] is None, c[0] or 0)):
        v = talks[conv, alone]
        if v not in prefixes and v not in seen:
            seen.add(v)
            kept.append((conv, len(v)))
    return kept


def damaged(rows):
    """Rows (conv, turn, role, text) after the fixed damage."""
    out = []
    for conv, turn, role, text in rows:
        part = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        role, text = part(role), part(text)
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def op13(rows):
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    talks = {r[0]: [] for r in rows}
    for r in damaged(rows):
        talks[r[0]].append(r[1:])
    return [(conv, *repaired(sorted(t, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))))
            for conv, t in talks.items()]


def repaired(talk):
    """All edits of a talk's rows (turn, role, text), the least (cost, letters) per number of rows and roles so far."""
    turns = {t for t, _, _ in talk if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, n = set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    best = {"": (0, "", ())}    # roles so far, shortened to what decides the rest

    def short(roles):
        return roles if roles in ("", "s") else roles[-1]

    def fits(roles, r):
        return r in {"": "su", "s": "u", "u": "a", "a": "u"}[roles]

    def put(into, roles, item):
        if roles not in into or item[:2] < into[roles][:2]:
            into[roles] = item
            return True

    def inserts(at):
        todo = list(at)
        while todo:
            roles = todo.pop()
            cost, edits, lines = at[roles]
            for r in "ua":
                if fits(roles, r) and put(at, short(roles + r), (cost + 5, edits + "I", (*lines, ("user:" if r == "u" else "assistant:")))):
                    todo.append(short(roles + r))

    initials = []
    for _, role, text in talk:
        initials.append(role[:1])
        seeable = text.strip(" \t\n\x0b\x0c\r")
        fault = ("blank" if not seeable else "duplicate" if (role, text) in seen else "truncated" if seeable[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            n[fault] += 1
        inserts(best)
        new = {}
        for roles, (cost, edits, lines) in best.items():
            put(new, roles, (cost + 2, edits + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if role[:1] and fits(roles, role[:1]):
                put(new, short(roles + role[:1]), (cost + more, edits + "K", (*lines, f"{role}:{text}")))
            for r, name in (("u", "user"), ("a", "assistant")):
                if fits(roles, r):
                    put(new, short(roles + r), (cost + 1 + more, edits + "R", (*lines, f"{name}:{text}")))
        best = new
    inserts(best)
    cost, edits, lines = min(best[r] for r in ("", "a") if r in best)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, edits,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def op12(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, codebooks_sha256) by plain Lloyd rounds on Python integers."""
    fine = [(i, v, c) for i, v, c in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    fine = [r for r in fine if len(r[1]) == len(fine[0][1])]
    if not fine:
        return []
    n = len(fine[0][1])
    spans = [(k * n // parts, (k + 1) * n // parts) for k in range(parts)]
    cells = [[[math.floor(4096 * float(np.float32(x))) for x in v[lo:hi]] for lo, hi in spans] for _, v, _ in fine]
    books = [[c[k] for c in cells[:entries]] for k in range(parts)]
    for rd in range(rounds + 1):
        near = [[min((sum((a - b) ** 2 for a, b in zip(c[k], e)), j) for j, e in enumerate(books[k])) for k in range(parts)] for c in cells]
        if rd < rounds:
            for k in range(parts):
                for j in range(len(books[k])):
                    mine = [c[k] for c, a in zip(cells, near) if a[k][1] == j]
                    if mine:
                        books[k][j] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = sha(",".join(str(x) for b in books for e in b for x in e))
    error = [sum(d for d, _ in a) for a in near]
    total = Counter()
    for (_, _, c), e in zip(fine, error):
        total[c] += e
    return [(i, "".join(f"{j:02x}" for _, j in a), e, total[c], digest) for (i, _, c), a, e in zip(fine, near, error)]
