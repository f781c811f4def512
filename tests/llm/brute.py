"""Plain versions of the operators over lists of (doc_id, text), for tests."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def near_groups(rows):
    def fp(text):
        w = [x.lower() for x in words(text)]
        if not w:
            return 0
        shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)]
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = [fp(t) for _, t in rows]
    return list(zip([i for i, _ in rows], fps, components([i for i, _ in rows], fps)))


def components(ids, fps, most=4):
    """The least id of each item's component."""
    root = list(range(len(ids)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= most:
                root[top(a)] = top(b)
    least = {}
    for k, i in enumerate(ids):
        least[top(k)] = min(i, least.get(top(k), i))
    return [least[top(k)] for k in range(len(ids))]


def exact(rows):
    norm = lambda t: (t or "").encode().lower()
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    return sorted((i, max(groups[norm(t)]), len(groups[norm(t)]), i == max(groups[norm(t)]), hashlib.sha256(norm(t)).hexdigest()) for i, t in rows)


def substrings(rows):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 49):
            g = tuple(w[k : k + 50])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def measures(text):
    w = words(text)
    times = Counter(zip(w, w[1:], w[2:]))
    inside = {p for k, g in enumerate(zip(w, w[1:], w[2:])) if times[g] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").encode().split(b"\n") if WORD.search(x)]
    return len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(inside)


def longest_common(a, b):
    """By the full table; from the end, b's last line is left out first where that loses nothing."""
    most = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            most[i + 1][j + 1] = most[i][j] + 1 if x == y else max(most[i][j + 1], most[i + 1][j])
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.insert(0, (i, j))
        elif most[i][j - 1] == most[i][j]:
            j -= 1
        else:
            i -= 1
    return out


def patience(a, b):
    """Aligned positions, by recursion."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in patience(a[1:], b[1:])]
    if a[-1] == b[-1]:
        return patience(a[:-1], b[:-1]) + [(len(a) - 1, len(b) - 1)]
    both = [(i, b.index(x)) for i, x in enumerate(a) if a.count(x) == 1 and b.count(x) == 1]
    if not both:
        common_a, common_b = [i for i, x in enumerate(a) if x in b], [j for j, x in enumerate(b) if x in a]
        return [(common_a[i], common_b[j]) for i, j in longest_common([a[i] for i in common_a], [b[j] for j in common_b])]
    longest = lambda r: (len(r), -r[-1][1] if r else 0)  # noqa: E731  of equally long runs the one that ends lowest in b
    runs = []  # the longest rising run that ends with each match
    for k, (_, j) in enumerate(both):
        runs.append([*max((r for r in runs if r[-1][1] < j), key=longest, default=[]), both[k]])
    run = max(runs, key=longest)
    out, at = [], (-1, -1)
    for i, j in [*run, (len(a), len(b))]:
        out += [(at[0] + 1 + x, at[1] + 1 + y) for x, y in patience(a[at[0] + 1 : i], b[at[1] + 1 : j])]
        out += [(i, j)] if i < len(a) and j < len(b) and (i, j) in run else []
        at = (i, j)
    return out


def line_keys(split, min_words):
    """The lines, pairs of neighbours, and runs of enough words that are not longer than needed at both ends."""
    n = [len(words(x)) for x in split]
    spans = {(i, j) for j in range(len(n) + 1) for i in range(max(0, j - 40), j)}
    enough = {x for x in spans if sum(n[slice(*x)]) >= min_words}
    return {tuple(split[slice(*x)]) for x in spans if x[1] - x[0] <= 2 or x in enough and not {(x[0], x[1] - 1), (x[0] + 1, x[1])} <= enough}


def lines(rows, min_words=5, all_pairs=False):
    """doc_id, what is left, lines, lines cut; with ``all_pairs`` every document is aligned with all earlier ones."""
    split = {i: [x for x in (t or "").split("\n") if words(x)] for i, t in rows}
    having = defaultdict(set)
    for i, x in split.items():
        for key in line_keys(x, min_words):
            having[key].add(i)
    partners = defaultdict(set)
    for who in having.values():
        for i in who:
            partners[i] |= {p for p in who if p < i} if all_pairs else {min(who)} - {i}
    out = []
    for i, t in rows:
        gone = set()
        for p in partners[i]:
            block, last = [], None
            for a, b in [*patience(split[p], split[i]), (-9, -9)]:
                if last != (a - 1, b - 1):
                    if sum(len(words(split[i][x])) for x in block) >= min_words:
                        gone.update(block)
                    block = []
                block.append(b)
                last = (a, b)
        kept, k = [], -1
        for x in (t or "").split("\n"):
            k += bool(words(x))
            if not (words(x) and k in gone):
                kept.append(x)
        out.append((i, "\n".join(kept), len(split[i]), len(gone)))
    return out
