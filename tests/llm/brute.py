"""Brute-force versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

SPAN = 50


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letters(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def shingles(words):
    """Five-word shingles; fewer words are one."""
    return [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def aligned_similarity(x, y):
    if not x or not y:
        return 0.0
    n = lcs(x, y)
    return n / (len(x) + len(y) - n)


def near_duplicate_classes(docs, least=0.8):
    """doc_id -> smallest doc_id of its class, by comparing all pairs that share a shingle."""
    parent = {d: d for d, _ in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    seqs = {d: shingles(tokens(t)) for d, t in docs if tokens(t)}
    holders = defaultdict(set)
    for d, s in seqs.items():
        for x in s:
            holders[x].add(d)
    both = Counter()
    counts = {d: Counter(s) for d, s in seqs.items()}
    for ds in holders.values():
        ds = sorted(ds)
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                both[a, b] += 1
    for a, b in both:
        shared = sum((counts[a] & counts[b]).values())
        total = len(seqs[a]) + len(seqs[b])
        if shared / (total - shared) < least or root(a) == root(b):
            continue
        if aligned_similarity(seqs[a], seqs[b]) >= least:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d, _ in docs}


def removed_repeats(docs):
    """doc_id -> (bytes, removed, spans, sha256 of the rest); ids are distinct."""
    least = {}
    raw = {d: (t or "").encode() for d, t in docs}
    for d in sorted(raw):
        for i in range(len(raw[d]) - SPAN + 1):
            least.setdefault(raw[d][i : i + SPAN], d)
    out = {}
    for d, b in raw.items():
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - SPAN + 1):
            if least[b[i : i + SPAN]] < d:
                gone[i : i + SPAN] = True
        runs = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def weighted_jaccard(x, y):
    x, y = Counter(x), Counter(y)
    both = sum((x & y).values())
    total = sum((x | y).values())
    return both / total if total else 0.0


def leaks(docs, items, least=0.8):
    """{(doc_id, item_id)} of items with a window of their own length at least so similar."""
    out = set()
    for item, text in items:
        words = letters(text)
        if len(words) < 5:
            continue
        own, kinds = shingles(words), set(shingles(words))
        for doc, body in docs:
            have = letters(body)
            if not kinds & set(shingles(have)):
                continue
            n = len(words)
            for i in range(max(len(have) - n, 0) + 1):
                if len(have[i : i + n]) >= 5 and weighted_jaccard(own, shingles(have[i : i + n])) >= least - 1e-9:
                    out.add((doc, item))
                    break
    return out


def nearest(vectors, queries, k):
    """query -> [(vec_id, distance)] over {vec_id: vector}."""
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - np.asarray(vectors[q], float)) ** 2).sum(1))
        rows = sorted((v, i) for v, i in zip(d.tolist(), ids.tolist()) if i != q)[:k]
        out[q] = [(i, v) for v, i in rows]
    return out


def auc(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    score, label = np.asarray(score), np.asarray(label)
    for v in np.unique(score):
        same = score == v
        ranks[same] = ranks[same].mean()
    pos = label.sum()
    return (ranks[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(label) - pos)) if 0 < pos < len(label) else math.nan


def encoded(docs, file):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    found = {}
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        found[doc_id] = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), back)))
    return found


def ranked(docs, items, k=10):
    """{item_id: [(doc_id, score), ...]}; docs and items are (id, text)."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    terms = [(d, Counter(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate(low)))) for d, t in docs]
    terms = [(d, c) for d, c in terms if c]
    n_docs, n_terms = len(terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(low)))
    found = {}
    for item, words in wanted.items():
        scores = []
        for d, c in terms:
            m = 10 + (90 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in words if t in c)
            if score > 0:
                scores.append((-score, d is None, d, score))
        if scores:
            found[item] = [(d, s) for _, _, d, s in sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k]]
    return found


def spelling(docs):
    """{word: (form, root, n, n_near, form_n)}."""
    import zlib

    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    by_gap = defaultdict(set)
    for w in counts:
        by_gap[w, None].add(w)
        for i in range(len(w)):
            by_gap[w[:i] + w[i + 1 :], i].add(w)  # one code point replaced
            by_gap[w[:i] + w[i + 1 :], None].add(w)  # or deleted
    near = defaultdict(set)
    for (text, gap), some in by_gap.items():
        for w in some:
            near[w] |= {x for x in some if x != w and (gap is not None or text in (w, x))}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def kneser_ney_ratios(labelled, text, discount=2.0):
    """log P(word | before, toxic) - log P(word | before, ordinary) of every word of ``text``."""
    before = lambda words: zip([None, *words], words)
    pairs = {c: Counter(p for t, y in labelled if y == c for p in before(letters(t))) for c in (1, 0)}
    types = {c: Counter(w for _, w in pairs[c]) for c in (1, 0)}
    shared = Counter(w for _, w in {*pairs[1], *pairs[0]})
    logs = []
    for c in (1, 0):
        rest = lambda n: max(n - discount, 0.0)
        n_types = sum(types[c].values())
        own = {w: rest(n) / n_types for w, n in types[c].items()}
        left = 1 - sum(own.values())
        sizes, held = Counter(), Counter()
        for (h, w), n in pairs[c].items():
            sizes[w] += n
            held[h] += rest(n)
        row = []
        for h, w in before(letters(text)):
            low = own.get(w, 0.0) + left * (shared[w] / sum(shared.values()) if shared[w] else 1e-6)
            known = h is not None and sizes[h] > 0
            row.append(math.log((rest(pairs[c][h, w]) / sizes[h] if known else 0.0) + (max(1 - held[h] / sizes[h], 1e-3) if known else 1.0) * low))
        logs.append(row)
    return [a - b for a, b in zip(*logs)]
