"""Plain forms of the operators' contracts, row by row, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from xxhash import xxh64_intdigest

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def decontamination(docs, items, size=10):
    """{doc_id: (n_words, n_hit, n_items, sha)}"""
    wins = defaultdict(set)
    for item, text in items:
        ws = BENCH_WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(ws) - size + 1)) if ws else ():
            wins[tuple(ws[i:i + size])].add("" if item is None else str(item))
    lengths = sorted({len(w) for w in wins})
    out = {}
    for doc, text in docs:
        ws = BENCH_WORD.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(ws) - n + 1):
                if (found := wins.get(tuple(ws[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    names |= found
        out[doc] = (len(ws), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())
    return out


def fingerprint(text):
    ws = SPACE_WORD.findall((text or "").translate(LOWER))
    if not ws:
        return 0
    shingles = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def simhash(docs, distance=3):
    """{doc_id: (fingerprint, component)}"""
    fp = {d: fingerprint(t) for d, t in docs}
    least = {}
    for d, f in fp.items():
        least[f] = min(d, least.get(f, d))
    fs = list(least)
    linked = [(least[a], least[b]) for i, a in enumerate(fs) for b in fs[:i] if (a ^ b).bit_count() <= distance]
    of = components(least.values(), linked)
    return {d: (f"{f:016x}", of[least[f]]) for d, f in fp.items()}


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight, the excess over the caps shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def repeats(docs, length=200):
    """{doc_id: (n_bytes, n_removed, n_spans, sha)}"""
    raw = {d: (t or "").encode() for d, t in docs}
    seen = Counter(b[i:i + length] for b in raw.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    ws = SPACE_WORD.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    windows = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = {j for i in range(len(ws) - 7) if windows[tuple(ws[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def repaired(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)} of (conv_id, turn, role, text), by plain search."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        here = convs[conv]
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            here += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return {conv: _repaired(here) for conv, here in convs.items()}


def _repaired(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\r\v\f")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    ways = {"": (0, "", ())}  # the end of what is kept so far: "", s, u or a

    def moves(state, role):
        return role if role + state in ("s", "u", "us", "au", "ua") else None

    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit, kept) in list(ways.items()):
                new = "a" if state == "u" else "u"
                ways[new] = min(ways.get(new, (10**9,)), (cost + 5, audit + "I", (*kept, ("assistant" if new == "a" else "user", ""))))
        return ways

    for (_, role, text), fault in zip(rows, faults, strict=True):
        then = {}
        for state, (cost, audit, kept) in inserted(ways).items():
            options = [(state, 2, "D", kept)]
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                if moves(state, role[:1]):
                    options.append((role[:1], late, "K", (*kept, (role, text))))
                new = "a" if state == "u" else "u"
                options.append((new, 1 + late, "R", (*kept, ("assistant" if new == "a" else "user", text))))
            for to, c, letter, left in options:
                then[to] = min(then.get(to, (10**9,)), (cost + c, audit + letter, left))
        ways = then
    cost, audit, kept = min(inserted(ways)[s] for s in ("", "a") if s in ways)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


def rebuilt(rows):
    """{conv_id: [(role, text)]}"""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        own[conv].append(((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if c is not None else 0
        base = own.get(c - c % 20, []) if h else []
        out[c] = base[:h] + turns[h:]
    return out


def trie(convs):
    """Sorted rows (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, sha) of {conv_id: turns}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    order = lambda c: (c is None, c or 0)
    rep = {k: min(v, key=order) for k, v in members.items()}
    children, leaves, saved = Counter(), Counter(), Counter()
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, v in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(v) - 1) * len(SPACE_WORD.findall(k[-1][1])) if k else 0
    out = []
    for k, v in members.items():
        ends = sorted((c for c in v if len(convs[c]) == len(k)), key=lambda c: (c is not None, c or 0))
        sha = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((rep[k], len(k), rep[k[:-1]] if k else None, len(v), children[k], leaves[k], saved[k], sha))
    return sorted(out, key=repr)


def preferences(rows):
    """{conv_id: (n_prompt_turns, prompt, chosen, mask, rejected, mask, reason)} of conversations against themselves with a stale last reply."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is not None, turn or 0), role, text))

    def segments(rows, at):
        return sorted({(f"<|{r or 'user'}|>\n{t or ''}<|end|>\n", r == "assistant") for a, r, t in rows if a == at})

    def stale(own):
        replies = [(a, t or "") for a, r, t in own if r == "assistant"]
        if not replies:
            return own
        last = max(replies)
        for role in ("assistant", "user"):
            said = [(a, t or "") for a, r, t in own if r == role and a < last[0] and (t or "") != last[1]]
            if said:
                return [x for x in own if not (x[0] == last[0] and x[1] == "assistant")] + [(last[0], "assistant", max(said)[1])]
        return own

    out = {}
    for conv, own in convs.items():
        other = stale(own)
        ats = sorted({a for a, _, _ in own})
        first = next((i for i, a in enumerate(ats) if segments(own, a) != segments(other, a)), len(ats))
        sides = [[s for a in ats[first:] for s in segments(side, a)] for side in (own, other)]
        text = lambda ss: "".join(t for t, _ in ss)
        mask = lambda ss: "".join(str(int(m)) for _, m in ss)
        prompt = text([s for a in ats[:first] for s in segments(own, a)])
        out[conv] = (first, prompt, text(sides[0]), mask(sides[0]), text(sides[1]), mask(sides[1]), "equal sides" if first == len(ats) else None)
    return out
