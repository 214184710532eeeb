"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return WORD.findall((text or "").encode().translate(LOWER))


def components(docs, size, percent):
    """{row: (set size, component)} for (doc_id, text) rows, by comparing all that share a shingle."""
    sets = []
    for _, text in docs:
        w = words(text)
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for e in s:
            holders[e].append(i)
    common = Counter(p for rows in holders.values() for p in itertools.combinations(rows, 2))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None and sets[i]:
            least[root(i)].append(doc_id)
    return [(doc_id, len(sets[i]),
             min(least[root(i)], default=None) if sets[i] else doc_id)
            for i, (doc_id, _) in enumerate(docs)]


def without_repeats(docs, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for (doc_id, text) rows."""
    raws = [(text or "").encode() for _, text in docs]
    seen = Counter(r[k:k + length] for r in raws for k in range(len(r) - length + 1))
    out = []
    for (doc_id, _), r in zip(docs, raws, strict=True):
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if seen[r[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, x in zip(r, gone, strict=True) if not x)
        out.append((doc_id, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_figures(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    inside = {k + j for k in range(len(w) - 7) if runs[tuple(w[k:k + 8])] > 1 for j in range(8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside))


def edit_distance(item, run):
    row = list(range(len(run) + 1))
    for i, a in enumerate(item, 1):
        row, before = [i], row
        for j, b in enumerate(run, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[-1] + 1))
    return row[-1]


def contains(text, item, share):
    """Whether some run of the text's words is within the share of the item's words, by edits."""
    t, m = words(text), words(item)
    edits = int(share * len(m) + 1e-9)
    if not m:
        return False
    row = [0] * (len(t) + 1)  # the item may begin anywhere
    for i, a in enumerate(m, 1):
        row, before = [i], row
        for j, b in enumerate(t, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[-1] + 1))
    return bool(t) and min(row) <= edits
