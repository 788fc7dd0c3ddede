"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    ws = words(text)
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    count = collections.Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
    }


def rejected(m):
    return (
        m["n_words"] < 50
        or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        or 100 * m["n_symbols"] > 10 * m["n_words"]
        or 100 * m["n_dup_lines"] > 40 * m["n_lines"]
        or m["word_chars"] < 2 * m["n_words"]
        or m["word_chars"] > 12 * m["n_words"]
    )


def without_lines(docs, ratio, least):
    """docs: list of (site, text); the texts without boilerplate lines."""
    bare = [[x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")] for _, t in docs]
    pages, seen = collections.Counter(s for s, _ in docs), collections.Counter()
    for (site, _), lines in zip(docs, bare):
        seen.update((site, x) for x in set(lines) if x)
    out = []
    for (site, text), lines in zip(docs, bare):
        drop = [x and seen[site, x] >= least and seen[site, x] > ratio * pages[site] for x in lines]
        if text is not None:
            text = "\n".join(x for x, d in zip(text.split("\n"), drop) if not d)
        out.append(text)
    return out


def shingles(text, size=5):
    ws = words((text or "").translate(LOWER))
    if len(ws) < size:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}


def components(rows, percent=85):
    """rows: list of (id, text); number of shingles and smallest id by place in the list."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [(len(sets[i]), least[find(i)], find(i)) for i in range(len(rows))]


def without_repeats(texts, window=35):
    lists = [words(t) for t in texts]
    count = collections.Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out




def tiled(item, doc, least):
    """Greedy string tiling one longest match at a time."""
    free_a, free_b, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and free_a[i + n] and free_b[j + n] and item[i + n] == doc[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        free_a[i : i + n] = free_b[j : j + n] = [False] * n
        out.append(n)


def targets(sizes, weights=(3, 1, 2)):
    """sizes: words per source in order; the target of each."""
    total, capped = 1.5 * sum(sizes), set()
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    while True:
        left = total - sum(2 * sizes[i] for i in capped)
        free = [i for i in range(len(sizes)) if i not in capped]
        share = {i: left * weight[i] / sum(weight[k] for k in free) for i in free}
        above = {i for i in free if share[i] > 2 * sizes[i]}
        if not above:
            return [2.0 * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped |= above
