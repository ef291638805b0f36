"""Plain single-machine versions of the operators, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size=2):
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def near(rows, size=2, percent=80):
    """{doc_id: (n_shingles, component)} by exact comparison of all that share a shingle."""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = collections.defaultdict(list)
    for i in sorted(sets):
        common = collections.Counter()
        for s in sets[i]:
            common.update(index[s])
            index[s].append(i)
        for j, c in common.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def cut(rows, window=50):
    """{doc_id: (n_words, n_removed, sha256)} after removal of repeated windows."""
    import hashlib

    least, split = {}, {i: WORD.findall(t or "") for i, t in rows}
    for i, w in split.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            least[key] = min(least.get(key, i), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def cut_lines(rows, run, words=10):
    """{doc_id: (text, n_removed)} without the later occurrences of ``run`` lines, or one of ``words`` words."""
    seqs = {i: [(k, x) for k, x in enumerate((t or "").split("\n")) if WORD.search(x)] for i, t in rows}
    seen, gone = set(), {i: set() for i in seqs}
    for i in sorted(seqs):
        for k in range(len(seqs[i])):
            for size in {1, run}:
                part = seqs[i][k:k + size]
                key = tuple(x for _, x in part)
                if len(part) < size or size < run and len(WORD.findall(key[0])) < words:
                    continue
                if key in seen:
                    gone[i].update(n for n, _ in part)
                seen.add(key)
    return {
        i: (t and "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), len(gone[i])) for i, t in rows}


def suffixes(rows):
    """[(doc_id, line among those with words, common lines with the suffix before)] in the order of the suffix array."""
    seqs = {i: [hashlib.md5(x.encode()).digest() for x in (t or "").split("\n") if WORD.search(x)] for i, t in rows}
    order = sorted((i, k) for i in seqs for k in range(len(seqs[i])))
    order.sort(key=lambda x: [*[(1, v) for v in seqs[x[0]][x[1]:]], (0, x[0])])
    out, last = [], []
    for i, k in order:
        own = seqs[i][k:]
        out.append((i, k, next((n for n, (a, b) in enumerate(zip(own, last, strict=False)) if a != b), min(len(own), len(last)))))
        last = own
    return out


def runs(sequence, min_length=24, copies=3):
    """[(start, length, smallest period)] of every maximal run, by trying all periods."""
    n, best = len(sequence), {}
    for q in range(1, n // copies + 1):
        start = 0
        for i in range(q, n + 1):
            if i == n or sequence[i] != sequence[i - q]:
                if i - start >= max(min_length, copies * q):
                    best.setdefault((start, i), q)
                start = i - q + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapse(sequence, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return [w for k, w in enumerate(sequence) if k not in gone]


def with_tail(doc_id, text):
    import zlib

    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def variants(rows, odd=97, least=3, factor=2):
    """{word: (form, root, n, n_near, form_n)} by trying every deletion of every word."""
    import zlib

    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
            at = h % len(run)
            counts[run if h % odd else run[:at] + run[at + 1:]] += 1
    counts = {w: n for w, n in counts.items() if n >= least and len(w) >= 5}
    holes = collections.defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            holes[k, w[:k] + w[k + 1:]].add(w)
    near = {w: set() for w in counts}
    for (_, short), ws in holes.items():
        for w in ws:
            near[w] |= ws - {w}
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    out = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        out[w] = best if best and counts[best] >= factor * n else None

    def root(w):
        return root(out[w]) if out[w] else w

    return {w: (out[w], root(w), n, len(near[w]), counts.get(out[w])) for w, n in counts.items()}


def cut_bytes(rows, window=400):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256)] after removal of all windows that start twice."""
    import hashlib

    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k:k + window] for _, b in texts for k in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        off = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if seen[b[k:k + window]] > 1:
                off[k:k + window] = b"\1" * window
        spans = sum(1 for k, x in enumerate(off) if x and not (k and off[k - 1]))
        kept = bytes(x for x, gone in zip(b, off, strict=True) if not gone)
        out.append((i, len(b), sum(off), spans, hashlib.sha256(kept).hexdigest()))
    return out
