"""Plain versions of the operators: loops over all rows, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

BLANKS = " \t\n\x0b\x0c\r"


def lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def classes(n: int, linked) -> list[int]:
    """For items 0..n-1: the smallest item reachable; linked: pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return lower(host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def host_rule(url, rules):
    host, path = url_parts(url)
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.text), default=None)


def lines(rows):
    """[(id, text)] -> [(id, kept, n_lines, n_dropped)]."""
    key = lambda x: lower(x.strip(BLANKS))
    holders = defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(doc)
    out = []
    for doc, text in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if len(key(x)) < 20 or len(holders[key(x)]) < 3 or doc == max((d for d in holders[key(x)] if d is not None), default=None)]
        out.append((doc, "\n".join(kept), len(all_), len(all_) - len(kept)))
    return out


def simhash(text):
    import xxhash

    words = re.findall("[^\x20\x09-\x0d]+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode("utf-8"), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def simhash_rows(rows, links=3):
    rows = sorted(rows, key=lambda r: r[0])
    prints = [simhash(t) for _, t in rows]
    x = np.array(prints, dtype=np.uint64)
    pairs = [(i, i + 1 + int(j)) for i in range(len(x)) for j in np.nonzero(np.bitwise_count(x[i] ^ x[i + 1 :]) <= links)[0]]
    return [(doc, f"{p:016x}", rows[c][0]) for (doc, _), p, c in zip(rows, prints, classes(len(rows), pairs))]


def vectors(rows, cosine=0.9):
    """[(id, vector)] -> [(id, n_links, component, kept)], ids distinct."""
    rows = sorted(rows, key=lambda r: r[0])
    good = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for (_, v), g in zip(rows, good)]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
    links = np.bincount([k for p in pairs for k in p], minlength=len(rows))
    return [(doc, int(links[i]), rows[c][0], i == c) for i, ((doc, _), c) in enumerate(zip(rows, classes(len(rows), pairs)))]


def pieces(rows, tokenizer, capacity=4096):
    out = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            out.append((doc, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def best_fit_count(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= x]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= x
        else:
            rooms.append(capacity - x)
    return len(rooms)


def fewest_bins(lengths, capacity):
    """Exact, by trying all ways; for a handful of lengths."""
    best = len(lengths)

    def put(left, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not left:
            best = len(rooms)
            return
        x, *rest = left
        for k in range(len(rooms)):
            if rooms[k] >= x and rooms[k] not in rooms[:k]:
                put(rest, [*rooms[:k], rooms[k] - x, *rooms[k + 1 :]])
        put(rest, [*rooms, capacity - x])

    put(sorted(lengths, reverse=True), [])
    return best


def secret_spans(text):
    """The patterns as the contract words them: match, then drop what is too short."""
    text = text or ""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([either("password"), either("passwd"), either("secret"), either("token"), either("api") + "_?" + either("key")])
    out = []
    for m in re.finditer("(" + names + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def damaged_turns(rows):
    """[(conv, turn, role, text)] -> {conv: [(turn, role, text)]} after damage, in order."""
    out = {}
    none_first = lambda x: (x is not None, x or 0)
    for conv, turn, role, text in sorted(rows, key=lambda r: (none_first(r[0]), none_first(r[1]))):
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest_edits(turns):
    """[(initial, must go, truncated)] -> (cost, edits): from the end, over where the output stands in ``(s?(ua)+)?``."""
    from functools import cache

    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(i, at, inserts):
        ways = []
        if i == len(turns) and at in ("", "a"):
            ways.append((0, ""))
        if inserts < 3:
            ways += [(5, "I", i, after[at, x], inserts + 1) for x in "ua" if (at, x) in after]
        if i < len(turns):
            initial, must_go, truncated = turns[i]
            ways.append((2, "D", i + 1, at, 0))
            if not must_go:
                ways += [(5 * truncated, "K", i + 1, after[at, initial], 0)] if (at, initial) in after else []
                ways += [(5 * truncated + 1, "R", i + 1, after[at, x], 0) for x in "ua" if (at, x) in after]
        full = [w if len(w) == 2 else (w[0] + (rest := best(*w[2:]))[0], w[1] + rest[1]) for w in ways]
        return min(full, default=(10**9, ""))

    return best(0, "", 0)


def role_repairs(rows):
    """[(conv, turn, role, text)] as stored -> sorted result rows."""
    out = []
    for conv, turns in damaged_turns(rows).items():
        faults, seen = [], set()
        for _, role, text in turns:
            end = text.rstrip(BLANKS)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        first = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit = cheapest_edits([(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(turns, faults)])
        said, left = [], iter(turns)
        for e in audit:
            role, text = next(left)[1:] if e != "I" else ("", "")
            if e in "RI":
                role = "assistant" if said and said[-1][0].startswith("u") else "user"
            if e != "D":
                said.append((role, text))
        digest = sha("\n".join(f"{r}:{t}" for r, t in said))
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return out


def token_rows(rows, tokenizer, end_id=2):
    """[(id, text)] with distinct ids -> [(id, start, n, crc32)]."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def ordered_turns(rows):
    """[(conv, turn, role, text)] with distinct turns -> {conv: [(role, text)]} in order."""
    out = {}
    for conv, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def rebuilt_turns(rows):
    own = ordered_turns(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def trie_rows(conversations):
    """{conv: [(role, text)]} -> sorted node rows, by walking every prefix."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = sum(saved[k] for k in kids[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    up = lambda node: min(members[node[:-1]]) if node else None
    return [(min(m), len(node), up(node), len(m), len(kids[node]), leaves[node], saved[node], sha(",".join(map(str, sorted(ends[node]))))) for node, m in members.items()]


def ftrl(rows, epochs, alpha, beta, l1, l2):
    """Follow the regularised leader, a coordinate at a time; [(cells, values, label)] -> {cell or "bias": weight}."""
    import math

    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    for _ in range(epochs):
        for cells, values, label in rows:
            x = dict(zip(map(int, cells), map(float, values))) | {"bias": 1.0}
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            for k, v in x.items():
                g = (p - label) * v
                sigma = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha
                z[k] += g - sigma * w[k]
                n[k] += g * g
    return {k: weight(k) for k in list(z)}
