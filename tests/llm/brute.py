"""Plain Python versions of the contracts, one document or one small corpus at a time."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_signals(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def secret_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def wide_spans(text):
    """(begin, end, value) of long tokens with a letter, three digits and many changes of kind."""
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or ""):
        plain = re.sub("[^A-Za-z0-9]", "", m[0])
        changes = len(re.findall(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])|[a-z](?=[A-Z])", plain))
        if len(re.findall("[0-9]", m[0])) >= 3 and re.search("[A-Za-z]", m[0]) and changes * 6 >= len(plain):
            yield m.start(), m.end(), m[0]


def secret_digest(spans):
    names = ["assign", "access", "hex"]
    return hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def shingle_components(rows, width=4, percent=85):
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {}
    for doc, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[doc] = (
            {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
        )
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for doc, s in sets.items():
        for g in s:
            having[g].append(doc)
    shared = Counter()
    for docs in having.values():
        for i, a in enumerate(docs):
            for b in docs[:i]:
                shared[(a, b)] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {doc: (len(s), find(doc)) for doc, s in sets.items()}


def repeated_bytes(rows, length=50):
    """doc_id -> (bytes, removed, spans, sha256 of what stays)."""
    first = {}
    data = [(doc, (text or "").encode()) for doc, text in rows]
    for doc, b in data:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, doc), doc)
    out = {}
    for doc, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < doc:
                gone[i : i + length] = b"\x01" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[doc] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def mixed_positions(rows, target, schedule):
    """(id, copy) -> (taken, time) of one source's (id, size) rows: demand summed along the schedule, inverted by bisection."""

    def area(t):
        steps, whole = len(schedule) - 1, 0.0
        for k, (a, b) in enumerate(zip(schedule, schedule[1:], strict=False)):
            x = min(max(t * steps - k, 0.0), 1.0)
            whole += (a * x + (b - a) * x * x / 2) / steps
        return whole

    rows = sorted(rows, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())
    at, out = 0, {}
    for copy in range(2):
        for doc, size in rows:
            taken = min(size, max(round(target) - at, 0))
            if taken:
                low, high = 0.0, 1.0
                for _ in range(60):
                    mid = (low + high) / 2
                    low, high = (mid, high) if area(mid) / area(1.0) * target < at + taken / 2 else (low, mid)
                out[doc, copy] = (taken, low)
            at += size
    return out
