"""Plain Python versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_counts(text):
    w = WORD.findall(text or "")
    windows = list(zip(w, w[1:], w[2:]))
    inside = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def shingle_set(text, width=5):
    w = WORD.findall(fold_ascii(text))
    if not w:
        return set()
    return {tuple(w)} if len(w) < width else set(zip(*[w[k:] for k in range(width)]))


def near_components(texts, percent=85):
    """id -> (set size, smallest id of its component)."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            here = row[k + 1]
            row[k + 1] = last + 1 if x == y else max(row[k + 1], row[k])
            last = here
    return row[-1]


def license_places(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold_ascii(text))
    at = [(i, label) for phrase, label in phrases.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))
