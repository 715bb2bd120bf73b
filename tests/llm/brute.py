"""Plain Python versions of the operators' contracts, for small tables."""

import re
from collections import Counter

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def cut(text, pattern=SPACED):
    return pattern.findall((text or "").translate(_LOW))


def shingles(text):
    w = cut(text)
    if not w:
        return set()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def near_components(rows, similar=85):
    """rows of (doc_id, text): for each row (set size, smallest reachable id);
    linked from ``similar`` of 100 shingles in common."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= similar * (len(sets[i]) + len(sets[j]) - common):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    smallest = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            smallest[g] = min(d, smallest.get(g, d))
    return [(len(s), smallest.get(g)) for s, g in zip(sets, group)]


def contamination(text, items, n=10):
    """(words, hit words, item ids) by comparing every window."""
    w, hit, found = cut(text, ALNUM), set(), set()
    for item, other in items:
        o = cut(other, ALNUM)
        size = min(n, len(o))
        windows = {tuple(o[k : k + size]) for k in range(len(o) - size + 1)} if size else set()
        for k in range(len(w) - size + 1 if size else 0):
            if tuple(w[k : k + size]) in windows:
                hit.update(range(k, k + size))
                found.update([] if item is None else [str(item)])
    return len(w), len(hit), sorted(found)


def line_dedup(rows, min_words):
    """Texts without later copies of line runs, by comparing every run."""
    keep = {}
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, _md5(r[1])))
    seen, gone = {}, {}
    for at, (_, text) in enumerate(order):
        full = [(i, s) for i, s in enumerate(text.split("\n")) if cut(s)] if text is not None else []
        counts = [len(cut(s)) for _, s in full]
        for a in range(len(full)):
            for b in range(a, len(full)):
                if sum(counts[a : b + 1]) >= min_words:
                    run = tuple(s for _, s in full[a : b + 1])
                    if seen.setdefault(run, (at, a)) < (at, a):
                        gone.setdefault(at, set()).update(i for i, _ in full[a : b + 1])
    for at, row in enumerate(order):
        lines = row[1].split("\n") if row[1] is not None else None
        cut_out = gone.get(at, set())
        keep[row] = None if lines is None else "\n".join(s for i, s in enumerate(lines) if i not in cut_out)
    return keep


def _md5(text):
    import hashlib

    return hashlib.md5((text or "").encode()).hexdigest()


def token_counts(texts):
    counts = Counter()
    for t in texts:
        counts.update([*cut(t), None])
    return counts


def damage(rows):
    """The faults of the repair query, in (conv_id, turn, role, text) rows."""
    import zlib

    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        pick = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        if pick == 0:
            continue
        text = "" if pick == 1 else re.sub("[.!?]", "", shown[3]) if pick == 2 else shown[3]
        out += [(conv, turn, "user" if pick == 4 else shown[2], text)] * (2 if pick == 3 else 1)
    return out


def repaired(rows):
    """One conversation's (turn, role, text) rows: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.findall("[^\x20\x09-\x0d]", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # The cheapest edits of the first rows that give each kind of initials so far, as (cost, audit, lines).
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}
    full = {"u": "user", "a": "assistant"}

    def put(into, state, entry):
        into[state] = min(into.get(state, entry), entry)

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                for i in "ua":
                    if (state, i) in steps:
                        put(table, i, (cost + 2, audit + "I", (*lines, full[i] + ":")))
        return table

    inserted(best)
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in best.items():
            put(after, state, (cost + 3, audit + "D", lines))
            if fault in ("", "truncated"):
                more = fault == "truncated"
                if (state, role[:1]) in steps:
                    put(after, role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for i in "ua":
                    if (state, i) in steps:
                        put(after, i, (cost + 2 + more, audit + "R", (*lines, f"{full[i]}:{text}")))
        best = inserted(after)
    cost, audit, lines = min(e for s, e in best.items() if s in ("", "a"))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, "\n".join(lines)
