"""Plain single-threaded versions of the operators' contracts, for tests."""
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lower_az(text):
    return (text or "").translate(LOWER)


def alnum_words(text):
    return ALNUM.findall(lower_az(text))


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def license_base(text):
    words = alnum_words(text)
    at, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def edited(rows):
    """doc_id -> edited text, rows = [(doc_id, text)] with distinct ids."""
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for n, (i, t) in enumerate(rows):
        q, nxt = len(t) // 4, rows[(n + 1) % len(rows)][1]
        out[i] = t[:len(t) - q] + nxt[:q]
    return out


def shingle_set(text, k=3):
    w = SPACE.findall(lower_az(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_components(rows, percent=85, k=3):
    """doc_id -> (set size, component) for rows = [(doc_id, text)], by comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = {}
    for i in sorted(sets):
        shared = {}
        for s in sets[i]:
            for j in index.get(s, ()):
                shared[j] = shared.get(j, 0) + 1
            index.setdefault(s, []).append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def byte_dedup(rows, window=100):
    """doc_id -> (bytes, removed, maximal runs, kept bytes), rows = [(doc_id, text)]."""
    first, out = {}, {}
    rows = sorted((i, (t or "").encode()) for i, t in rows)
    for i, t in rows:
        for p in range(len(t) - window + 1):
            first.setdefault(t[p:p + window], (i, p))
    for i, t in rows:
        gone = bytearray(len(t))
        end = 0
        for p in range(len(t) - window + 1):
            if first[t[p:p + window]] != (i, p):
                for q in range(max(p, end), p + window):
                    gone[q] = 1
                end = p + window
        runs = sum(1 for q in range(len(t)) if gone[q] and not (q and gone[q - 1]))
        out[i] = len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g)
    return out


def word_dedup(rows, window=50):
    """doc_id -> (words, removed, kept text), rows = [(doc_id, text)]."""
    first, docs = {}, {i: SPACE.findall(t or "") for i, t in rows}
    for i in sorted(docs):
        for p in range(len(docs[i]) - window + 1):
            first.setdefault(tuple(docs[i][p:p + window]), i)
    out = {}
    for i, w in docs.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out[i] = len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)
    return out


def contamination(rows, items, window=10):
    """doc_id -> (words, hit words, items, joined ids), rows = [(doc_id, text)], items = [(item_id, text)]."""
    index = {}
    for i, t in items:
        w = alnum_words(t)
        for p in range(max(1, len(w) - window + 1) if w else 0):
            index.setdefault(tuple(w[p:p + window]), set()).add(str(i))
    sizes = {len(k) for k in index}
    out = {}
    for i, t in rows:
        w, hit, found = alnum_words(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                got = index.get(tuple(w[p:p + n]))
                if got:
                    found |= got
                    hit.update(range(p, p + n))
        out[i] = len(w), len(hit), len(found), ",".join(sorted(found))
    return out
