"""Plain definitions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def least_reachable(nodes, links):
    parent = {i: i for i in nodes}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in nodes}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(_LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_copies(rows):
    """{id: component} for (id, text) rows with ids."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    holders, links = defaultdict(list), []
    for at, (_, s) in enumerate(sets):
        for token in s:
            holders[token].append(at)
    for at, (i, s) in enumerate(sets):
        for other, n in Counter(o for token in s for o in holders[token] if o < at).items():
            if 100 * n >= 75 * (len(s) + len(sets[other][1]) - n):
                links.append((i, sets[other][0]))
    return least_reachable({i for i, _ in sets}, links)


def cosines(vectors):
    x = np.array(vectors, dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x @ x.T


def secret_spans(text, rules):
    found = [(m.start(), n, m.end(), r.kind) for n, r in enumerate(rules) for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least]
    return sorted(found)


def redacted(text, rules):
    for r in rules:
        text = None if text is None else re.sub(r.pattern, lambda m: f"[{r.kind}]" if len(m[r.group]) >= r.least else m[0], text)
    return text


def best_segments(scores):
    """All maximal scoring segments: the best one (of equals the shortest), then what is left of it and right of it."""
    best = (0.0, 0, 0)
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best[0] + 1e-9 or (best[0] and abs(total - best[0]) <= 1e-9 and j + 1 - i < best[2] - best[1]):
                best = (total, i, j + 1)
    if not best[0]:
        return []
    _, i, j = best
    left, right = best_segments(scores[:i]), best_segments(scores[j:])
    return left + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in right]


def whole_vector(v):
    return np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)


def refined(points, centres, rounds):
    """Nearest centres and floors of means, `rounds` times; then nearest centres: (centres, numbers, squared distances)."""
    points, centres = np.array(points), np.array(centres)
    for last in [False] * rounds + [True]:
        apart = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        number = apart.argmin(axis=1)
        if last:
            return centres, number, apart.min(axis=1)
        for c in range(len(centres)):
            own = points[number == c]
            if len(own):
                centres[c] = own.sum(axis=0) // len(own)


def clusters(rows, n, rounds):
    """Rows of (id, cluster, distance, cluster_inertia, inertia, centroid_sha256), sorted."""
    kept = [(i, whole_vector(v)) for i, v in rows]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v.tolist()) for i, v in kept)[:n]
    centres, number, far = refined([v for _, v in kept], [v for _, v in first], rounds)
    named = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    return sorted((i, int(c), int(d), int(far[number == c].sum()), int(far.sum()), named[c]) for (i, _), c, d in zip(kept, number, far))


def codes(rows, parts, entries, rounds):
    """Rows of (id, code, error, label_error, codebooks_sha256), sorted."""
    kept = [(i, whole_vector(v).reshape(parts, -1), label) for i, v, label in rows]
    first = sorted((i, v.ravel().tolist()) for i, v, _ in kept)[:entries]
    code, error, books = [""] * len(kept), np.zeros(len(kept), dtype=np.int64), []
    for p in range(parts):
        start = [np.array(v).reshape(parts, -1)[p] for _, v in first]
        centres, number, far = refined([v[p] for _, v, _ in kept], start, rounds)
        books += centres.ravel().tolist()
        error += far
        code = [a + f"{b:02x}" for a, b in zip(code, number)]
    of_label = Counter()
    for (_, _, label), e in zip(kept, error):
        of_label[label] += int(e)
    sha = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return sorted((i, c, int(e), of_label[label], sha) for (i, _, label), c, e in zip(kept, code, error))


def bundled(text, letters, symbol):
    """The sum over all trigrams of letters and single blanks between runs of the product of their shifted letter vectors."""
    symbols = [0]
    for c in text.lower():
        x = symbol(ord(c))
        if x or symbols[-1]:
            symbols.append(x)
    symbols += [0] if symbols[-1] else []
    out = np.zeros(letters.shape[1])
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        out += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return out


def language_profiles(labelled, letters, symbol):
    sums = defaultdict(lambda: np.zeros(letters.shape[1]))
    for text, lang in labelled:
        v = bundled(text, letters, symbol)
        if v.any():
            sums[lang] += v / np.linalg.norm(v)
    return {lang: v / np.linalg.norm(v) for lang, v in sums.items()}


def toxicity_model(labelled, k):
    """Log-odds with a Dirichlet prior, the law of chance segments and the cut, from (text, label) by loops; `k` holds the constants."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    seen = {0: Counter(), 1: Counter()}
    for text, label in labelled:
        own = set(words(text))
        for w in own | {w[:k.STEM] + "*" for w in own if len(w) > k.STEM}:
            seen[label][w] += 1
    every, n = set(seen[0]) | set(seen[1]), {x: sum(seen[x].values()) for x in (0, 1)}
    weights, clean = {}, {}
    for w in every:
        prior = (seen[0][w] + seen[1][w]) / (n[0] + n[1]) * k.PRIOR + k.FLOOR
        y = {x: seen[x][w] + prior for x in (0, 1)}
        rest = {x: n[x] + k.PRIOR + k.FLOOR * len(every) - y[x] for x in (0, 1)}
        odds = np.log(y[1] / rest[1]) - np.log(y[0] / rest[0])
        if abs(odds) / np.sqrt(1 / y[1] + 1 / y[0]) >= k.MIN_Z:
            weights[w], clean[w] = odds, seen[0][w]
    total = n[0] + 0.5 * len(weights)
    null = [(x, (clean[w] + 0.5) / total) for w, x in weights.items()] + [(k.DRIFT, (n[0] - sum(clean.values())) / total)]
    low, high = 1e-6, 1e3
    while high - low > 1e-12 * high:
        middle = (low + high) / 2
        low, high = (middle, high) if sum(p * np.exp(min(700.0, middle * s)) for s, p in null) < 1 else (low, middle)
    score = lambda w: weights.get(w, weights.get(w[:k.STEM] + "*", k.DRIFT) if len(w) > k.STEM else k.DRIFT)
    chance = sum(len(best_segments([score(w) for w in words(t)])) for t, label in labelled if not label)
    scale = (chance + 1) / n[0]

    def evidence(text):
        own, out = words(text), 0.0
        for _, _, s in best_segments([score(w) for w in own]):
            e = scale * max(1, len(own)) * np.exp(-low * s)
            out += -np.log(max(e, 1e-300)) if e <= k.MAX_E else 0.0
        return out

    told = sorted((evidence(t), label) for t, label in labelled)
    cuts = [(a[0] + b[0]) / 2 for a, b in zip([(0.0, 0), *told], told) if b[0] > a[0]] + [told[-1][0] + 1.0]
    cut = max(cuts, key=lambda c: (sum((e >= c) == bool(label) for e, label in told), -c))
    return {"weights": weights, "rate": low, "scale": scale, "cut": cut, "evidence": evidence}
