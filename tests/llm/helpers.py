"""Brute-force twins of the corpus operators, for small inputs."""

import re

import duckdb

TABLES = "documents embeddings pages benchmark labels conversations".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def duck(folder, **tables):
    con = duckdb.connect()
    for t in TABLES:
        if t not in tables:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    for name, pdf in tables.items():
        con.register(name, pdf)
    return con


def measures(text):
    words = WORD.findall(text or "")
    windows = {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k : k + 5]), []).append(k)
    covered = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
        len(re.findall("[A-Za-z]", text or "")),
        len(re.findall("[A-Z]", text or "")),
    )


def shingles(text):
    words = WORD.findall(text or "")
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def groups(n, links):
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(k) for k in range(n)]


def similar(texts):
    sets = [shingles(t) for t in texts]
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9
    ]


def cut_repeats(texts, length=100):
    """(removed, spans, kept) per text, in the order given."""
    seen, out = set(), []
    for data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in PII.items() for m in re.finditer(p, text or "") if ok(m.group())]
