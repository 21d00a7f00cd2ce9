"""Plain versions of the operators, for comparison on small inputs."""

import random
import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import xxhash


def lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def repeats(rows, window):
    """``doc_id, n_words, n_removed, kept_sha256``."""
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    order = lambda d: math.inf if d is None else d
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, math.inf), order(d))
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < order(d):
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def fingerprint(text):
    w = lower(text).split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, distance=4):
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= distance):
            label[top(int(j))] = top(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, f"{prints[i]:016x}", least.get(top(i))) for i, (d, _) in enumerate(rows)]


def similar_survivors(rows, size, least):
    """The smallest ``doc_id`` of each component of texts whose shingle sets are so similar."""
    sets, label = [], list(range(len(rows)))
    for _, text in rows:
        w = lower(text).split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= least * len(a | b):
                label[max(top(i), top(j))] = min(top(i), top(j))
    return sorted({min(d for k, (d, _) in enumerate(rows) if top(k) == t) for t in {top(i) for i in range(len(rows))}})


def licenses(text, rules):
    text = lower(text).decode()
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    line, found = " " + " ".join(words) + " ", []
    for number, (label, expression, _, priority, score, base) in enumerate(rules):
        for m in re.finditer(expression, line):
            start = line[: m.start()].count(" ")
            found.append((start, start + m.group().count(" "), priority, number, label, score, base))
    kept = [
        x for x in found
        if not any(
            y is not x and y[0] <= x[0] and y[1] >= x[1] and y[2] >= x[2] and (y[:3] != x[:3] or y[3] < x[3])
            for y in found
        )
    ]
    base = [x for x in found if x[6]]
    starts = [x[0] for x in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x[4] for x in base})), ",".join(sorted({x[4] for x in base + kept})),
        max((x[5] for x in kept), default=0.0),
    )


def base_scores(rows):
    """``doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)``."""
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    tokens = {d: [*lower(t).split(), None] for d, t in rows}
    counts = collections.Counter(w for d in tokens if not held[d] for w in tokens[d])
    total, words = sum(counts.values()), len(counts)
    return {
        d: (
            held[d], len(w), sum(counts[x] > 0 for x in w), total,
            sum(math.log10((counts[x] + 1) / (total + words + 1)) for x in w),
        )
        for d, w in tokens.items()
    }


def ranked(vectors, every, k, score):
    """``query_id, rank, vec_id, score`` over ``{vec_id: vector}``."""
    out = []
    for q in sorted(v for v in vectors if v % every == 0):
        others = [(-score(vectors[q], x), i) for i, x in vectors.items() if i != q and len(x) == len(vectors[q])]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(others)[:k], start=1)]
    return out


def failed_filters(rows):
    """Per row of ``(doc_id, lang, text)`` its part and the filters it fails."""
    order = lambda d: math.inf if d is None else d
    least = {}
    for d, _, t in rows:
        least[t or ""] = min(least.get(t or "", math.inf), order(d))
    out = []
    for d, lang, t in rows:
        text, words = t or "", (t or "").encode().split()
        fails = "A" if len(words) < 100 else ""
        fails += "B" if 100 * len(set(words)) < 80 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
        fails += "D" if re.search("[#$%&*|]", text) else ""
        fails += "E" if least[text] < order(d) else ""
        out.append((lang or "", fails))
    return out


def filter_audit(rows, labels):
    """Every order run document by document; ``labels`` are rows ``(doc_id, quality, toxic)``."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    judged = [(part, fails, d in good, d in toxic) for (part, fails), (d, _, _) in zip(failed_filters(rows), rows)]
    out, worth = [], collections.Counter()
    for part in sorted({x[0] for x in judged}):
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = [x for x in judged if x[0] == part], []
            for step, f in enumerate(order, start=1):
                failed = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in gone)
                alone = sum(x[0] == part and x[1] == f for x in judged)
                left = [x for x in left if f not in x[1]]
                gone += failed
                worth[part, f] += len(failed)
                out.append((part, order, step, len(left), len(failed), redundant, alone, sum(x[2] for x in failed), sum(x[3] for x in failed)))
    return [(*x, worth[x[0], x[1][x[2] - 1]]) for x in out]


def spelling_counts(rows):
    counts = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(counts):
    """``word, form, root, n, n_near, form_n`` by comparing every word with every other."""
    near = {w: [] for w in counts}
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[:i]:
            if one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 5 * counts[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w))))
    return out


def pitman_yor(lines, end, discounts, strength, sweeps):
    """A bigram model seated by taking out and seating anew one customer after the other.

    ``lines`` are tokens of texts, each with its ``end``. Returns p(word, context), averaged
    over the sweeps after the first.
    """
    rng = random.Random(5)
    d, parent_d = discounts
    words = len({w for line in lines for w in line})
    seats = collections.defaultdict(lambda: collections.defaultdict(list))  # context, word: customers per table
    parent = collections.defaultdict(list)  # word: tables of contexts per table
    customers = [(w, u) for line in lines for w, u in zip(line, [end, *line])]

    def above(w):
        tables, people = sum(map(len, parent.values())), sum(map(sum, parent.values()))
        base = 1 / (words + 1)
        return (sum(parent[w]) - parent_d * len(parent[w]) + (strength + parent_d * tables) * base) / (strength + people)

    def choose(tables, discount, new):
        weights = [n - discount for n in tables] + [new]
        return rng.choices(range(len(weights)), weights)[0]

    def seat_parent(w):
        tables = sum(map(len, parent.values()))
        at = choose(parent[w], parent_d, (strength + parent_d * tables) / (words + 1))
        parent[w][at:at + 1] = [parent[w][at] + 1 if at < len(parent[w]) else 1]

    def seat(w, u):
        tables = sum(map(len, seats[u].values()))
        at = choose(seats[u][w], d, (strength + d * tables) * above(w))
        if at == len(seats[u][w]):
            seats[u][w].append(1)
            seat_parent(w)
        else:
            seats[u][w][at] += 1

    def leave(tables):
        """One customer goes; whether its table goes with it."""
        at = rng.choices(range(len(tables)), tables)[0]
        tables[at] -= 1
        if not tables[at]:
            del tables[at]
            return True
        return False

    for w, u in customers:
        seat(w, u)
    samples = []
    for number in range(sweeps):
        for w, u in customers:
            if leave(seats[u][w]):
                leave(parent[w])
            seat(w, u)
        if number:
            shares = {w: above(w) for w in {w for w, _ in customers} | {None}}
            own = {(w, u): (sum(t), len(t)) for u, dishes in seats.items() for w, t in dishes.items()}
            each = {u: (sum(map(sum, x.values())), sum(map(len, x.values()))) for u, x in seats.items()}
            samples.append((shares, own, each))

    def p(w, u):
        out = 0
        for shares, own, each in samples:
            people, tables = each.get(u, (0, 0))
            n, t = own.get((w, u), (0, 0))
            out += (n - d * t + (strength + d * tables) * shares.get(w, shares[None])) / (strength + people)
        return out / len(samples)

    return p
