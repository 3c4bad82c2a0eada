"""Plain versions of what the operators must find, over small lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def repeats(docs, depth):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by looking at every window."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[s : s + depth] for _, b in raw for s in range(len(b) - depth + 1))
    out = []
    for i, b in raw:
        marks = bytearray(len(b))
        for s in range(len(b) - depth + 1):
            if seen[b[s : s + depth]] > 1:
                marks[s : s + depth] = b"\1" * depth
        kept = bytes(x for x, m in zip(b, marks) if not m)
        out.append((i, len(b), sum(marks), len(re.findall(b"\1+", bytes(marks))), hashlib.sha256(kept).hexdigest()))
    return out


def contamination(docs, items, window):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for s in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[s : s + n])] |= {str(item)} if item is not None else set()
    out = []
    for i, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                if (key := tuple(words[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[key]
        out.append((i, len(words), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def jaccard_classes(docs, size=5):
    sets = {}
    for i, text in docs:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[s : s + size]) for s in range(max(1, len(words) - size + 1))} if words else set()
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            one, two = sorted((find(a), find(b)))
            group[two] = one
    return [(i, len(s), find(i)) for i, s in sets.items()]


def near_counts(fingerprints, radius):
    return {a: sum(bin((a ^ b) & (2**64 - 1)).count("1") <= radius for b in fingerprints) for a in set(fingerprints)}


def water_fill(sizes, weights, share, max_epochs):
    """Target of each source by sharing again, round by round, what capped sources cannot give."""
    caps = [max_epochs * s for s in sizes]
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] > caps[i]}
        if not over:
            for i in free:
                target[i] = level * weights[i]
            break
        for i in over:
            target[i], left = caps[i], left - caps[i]
        free -= over
    return target


def rebuilt_conversations(rows):
    """{conv_id: [(role, text), ..]} of (conv_id, turn, role, text) rows, heads taken from the first of five."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2] if t[0] else (False, 0))] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # the remainder has the sign of c, as in SQL
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(rows):
    """One tuple a node: conv_id, depth, parent, members, children, leaves, saved, hash of the ids that end there."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt_conversations(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def totals(node):
        below = [totals(x) for x in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        return sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below)

    out = []
    for node, ids in members.items():
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(ids), len(node), parent, len(ids), len(children[node]), *totals(node), digest))
    return sorted(out, key=lambda r: r[:2])


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def filled_in(doc_id, text, seed=42, rate=50, spm_rate=80):
    """(n, form, prefix length, middle length, output) of one text."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    one, two = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:one], units[one:two], units[two:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"
