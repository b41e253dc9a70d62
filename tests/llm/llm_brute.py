"""Brute-force versions of the operators, over lists of (doc_id, text) or (doc_id, text, source)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def token_rows(docs, tokenizer):
    """Sorted by id (null first) and text: (doc_id, start, n_tokens, crc32)."""
    found, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def hits(docs, items, window=10):
    wanted = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if size else ():
            wanted[tuple(w[i : i + size])].add(str(item) if item is not None else "")
    sizes = {len(k) for k in wanted}
    for doc_id, text in docs:
        w, marked, held = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                found = wanted.get(tuple(w[i : i + size]))
                if found:
                    marked.update(range(i, i + size))
                    held |= found
        yield doc_id, len(w), len(marked), sorted(held)


def fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def linked(prints, distance=3):
    """The least index in each one's component."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= distance:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def near_rows(docs):
    prints = [fingerprint(text) for _, text in docs]
    roots = linked(prints)
    least = {}
    for (doc_id, _), r in zip(docs, roots):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(docs, prints, roots)]


def secret_spans(text):
    text = text or ""
    found = []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0):
    """Stops a target at its most and shares the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_ones, fixed = share * sum(sizes.values()), list(order), {}
    while open_ones:
        unit = left / sum(weight[s] for s in open_ones)
        over = [s for s in open_ones if unit * weight[s] > most * sizes[s]]
        if not over:
            return fixed | {s: unit * weight[s] for s in open_ones}
        for s in over:
            fixed[s] = most * sizes[s]
            left -= fixed[s]
            open_ones.remove(s)
    return fixed


def lpt(sizes: Counter, shards: int):
    """Groups by falling size (ties by name) to the least-loaded shard."""
    loads, found = [0] * shards, {}
    for group, size in sorted(sizes.items(), key=lambda g: (-g[1], g[0])):
        found[group] = min(range(shards), key=lambda s: (loads[s], s))
        loads[found[group]] += size
    return found


def without_repeats(docs, window=400):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    for (doc_id, _), text in zip(docs, texts):
        edge = np.zeros(len(text) + 1, dtype=int)
        for i in range(len(text) - window + 1):
            if seen[text[i : i + window]] > 1:
                edge[i] += 1
                edge[i + window] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        yield doc_id, len(text), int(gone.sum()), runs, sha(kept)


def whole_vector(vector, scale):
    """floor(scale * x) of each component, or None for a vector that takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * float(x)) for x in vector]


def best_products(rows, count=10, scale=1024, every=100):
    """Of rows that start with vec_id and vector: (query_id, rank, vec_id, score) of each query row."""
    kept = [(r[0], v) for r, v in ((r, whole_vector(r[1], scale)) for r in rows) if v is not None]
    for at, (query, asked) in enumerate(kept):
        if query is None or query % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(asked, v)), i is None, i or 0) for n, (i, v) in enumerate(kept) if n != at
        ]
        for rank, (score, none, i) in enumerate(sorted(scored)[:count], 1):
            yield query, rank, None if none else i, -score


def vector_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    """Of (vec_id, vector, label) rows: (vec_id, code, error, label_error, sha256 of the codebooks)."""
    kept = [(i, whole_vector(v, scale), label) for i, v, label in rows]
    kept = [r for r in kept if r[1] is not None]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = [[(v + [0] * (width * parts - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))[:entries]
    books = [[cut[n][p] for n in first] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for vector in cut:
                held[nearest(vector[p], books[p])[1]].append(vector[p])
            books[p] = [
                [sum(c) // len(held[k]) for c in zip(*held[k])] if held[k] else e for k, e in enumerate(books[p])
            ]
    found = [[nearest(vector[p], books[p]) for p in range(parts)] for vector in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    digest = sha(",".join(str(x) for book in books for e in book for x in e))
    return [
        (i, "".join(f"{k:02x}" for _, k in f), error, by_label[label], digest)
        for (i, _, label), f, error in zip(kept, found, errors)
    ]


def ranked(docs, items, count=50):
    """Of (doc_id, text) and (item_id, text) rows: (item_id, rank, doc_id, score), item by item."""
    terms = [Counter(words(t)) for _, t in docs]
    lengths = [sum(c.values()) for c in terms]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    held = Counter(t for c in terms for t in c)
    for item, text in items:
        scored = []
        for (doc_id, _), c, n in zip(docs, terms, lengths):
            m = 100 - 50 + 50 * n * n_docs // max(1, total)
            score = 0
            for t in set(words(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:count], 1):
            yield item, rank, None if none else doc_id, -score


def text_statistics(text):
    """The classifier's statistics of one text, by their names in the operator."""
    raw = (text or "").encode()
    w = words(text)
    kinds = Counter()
    for byte in raw:
        c = chr(byte)
        kinds[
            "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else
            "beyond" if byte > 127 else "newline" if c == "\n" else "space" if c in "\t\x0b\x0c\r " else
            "mark" if c in ".,;:!?'\"()-" else "symbol"
        ] += 1
    triples = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    lines = [tuple(sorted(words(line.decode("utf-8")))) for line in raw.split(b"\n")]
    lines = [line for line in lines if line]

    def share(part, whole):
        return part / max(whole, 1)

    n = len(w)
    return [
        math.log1p(len(raw)), math.log1p(n),
        *[share(kinds[k], len(raw)) for k in ("upper", "digit", "space", "newline", "mark", "symbol", "beyond")],
        share(sum(map(len, w)), n), share(sum(len(x) > 20 for x in w), n), share(sum(len(x) <= 3 for x in w), n),
        share(len(set(w)), n), share(max(Counter(w).values(), default=0), n),
        share(sum(a == b for a, b in zip(w, w[1:])), n), share(len(triples), n - 2), share(sum(raw.count(c) for c in b".!?"), n),
        math.log1p(share(n, len(lines))), share(len(set(lines)), len(lines)),
    ]


def quality_scores(docs, labels, fourier=256, width=8.0, strength=1e-4, seed=7, folds=5, step=0.005):
    """Scores of (doc_id, text) rows from (doc_id, 0 or 1) labels, with whole matrices."""
    stats = np.array([text_statistics(t) for _, t in docs]).reshape(len(docs), 19)
    train = [
        (i, zlib.crc32(str(d).encode()) % folds, y)
        for i, (d, _) in enumerate(docs) for k, y in labels if d is not None and d == k and y is not None
    ]
    train = [r for r in train if r[1] > 0]
    if not train:
        return [0.5] * len(docs)
    at, fold, y = (np.array(c) for c in zip(*train))
    mean, spread = stats[at].mean(axis=0), stats[at].std(axis=0)
    spread[spread <= 1e-9] = 1.0
    random = np.random.default_rng(seed)
    frequency, phase = random.normal(size=(19, fourier)) / width, random.uniform(0, 2 * np.pi, fourier)

    def features(x):
        waves = np.cos(np.clip((x - mean) / spread, -6, 6) @ frequency + phase) * np.sqrt(2 / fourier)
        return np.column_stack([waves, np.ones(len(x))])

    def solved(z, t):
        shrink = np.full(fourier + 1, strength * len(z))
        shrink[-1] = 1e-9
        return np.linalg.solve(z.T @ z + np.diag(shrink), z.T @ t)

    z = features(stats[at])
    raw = np.zeros(len(at))
    for k in set(fold.tolist()):
        raw[fold == k] = np.clip(z[fold == k] @ solved(z[fold != k], y[fold != k]), -1, 2)
    bins = defaultdict(list)
    for r, t in zip(raw, y):
        bins[math.floor(r / step + 0.5)].append((r, t))
    pools = []
    for k in sorted(bins):
        pools.append([*np.mean(bins[k], axis=0), len(bins[k])])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            (a, b, m), (c, d, n) = pools[-2:]
            pools[-2:] = [[(a * m + c * n) / (m + n), (b * m + d * n) / (m + n), m + n]]
    raw = features(stats) @ solved(z, y)
    level = np.interp(raw, [p[0] for p in pools], [p[1] for p in pools])
    return ((1 - 1e-3) * level + 1e-3 * np.clip(raw, 0, 1)).tolist()


SCHEDULES = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))


def training_order(docs):
    """Of (doc_id, text, source) rows: their indexes, one for each pass, in the order of training."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    by_source = defaultdict(list)
    for i, (doc_id, text, source) in enumerate(docs):
        by_source[source].append((sha(f"{doc_id if doc_id is not None else ''}|{text or ''}"), size[i], i))
    totals = {s: sum(r[1] for r in held) for s, held in by_source.items()}
    wanted = targets(totals)
    entered = []
    for nth, source in enumerate(sorted(totals, key=lambda s: (s is None, (s or "").encode()))):
        start, end = SCHEDULES[nth % 3]
        given, demand = 0, math.floor(wanted[source] + 0.5)
        for again in range(2):
            for _, words_, i in sorted(by_source[source]):
                if given < demand:
                    asked = given / wanted[source]
                    at = asked * 2 / (start + math.sqrt(start * start + (end - start) * 2 * asked))
                    entered.append((at, docs[i][0] is not None, docs[i][0] or 0, i))
                given += words_
    return [e[-1] for e in sorted(entered)]
