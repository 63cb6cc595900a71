"""Plain Python counterparts of the operators, for small tables."""

import re
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def rows_of(texts):
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, size):
    words = [lower(w) for w in WORD.findall(text or "")]
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def linked(rows, size, percent):
    """doc_id -> (set size, smallest doc_id reachable) for unique ids."""
    sets = {i: shingles(t, size) for i, t in rows}
    lists = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            lists[g].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        common = defaultdict(int)
        for g in s:
            for j in lists[g]:
                if j > i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def deduped_lines(rows, near_chars):
    """(doc_id, text or None if dropped) for rows with unique ids."""
    places = sorted((i, k, line) for i, t in rows for k, line in enumerate((t or "").split("\n")) if line.strip(" "))
    gone = set()
    for n, (i, k, line) in enumerate(places):
        for _, _, other in places[:n]:
            if other == line or min(len(other), len(line)) >= near_chars and abs(len(other) - len(line)) < 2 and distance(other, line) < 2:
                gone.add((i, k))
                break
    out = {}
    for i, t in rows:
        if t is None:
            out[i] = None
            continue
        lines = t.split("\n")
        kept = [x for k, x in enumerate(lines) if (i, k) not in gone]
        if any((i, k) in gone for k in range(len(lines))) and not any(x.strip(" ") for x in kept):
            continue
        out[i] = "\n".join(kept)
    return out
