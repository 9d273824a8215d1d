"""Plain versions of the operators, for small tables."""


def shingle_set(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def near(rows, percent=80, roots=False):
    """(set size, component's smallest id) of each row, or the components' roots (None without a set), for (doc_id, text) rows, by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    lists = {}
    for k, s in enumerate(sets):
        for x in s:
            lists.setdefault(x, []).append(k)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    seen = set()
    for own in lists.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        root[find(a)] = find(b)
    if roots:
        return [find(k) if sets[k] else None for k in range(len(rows))]
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[find(k)] = min(least.get(find(k), key), key)
    return [(len(sets[k]), least.get(find(k)) if sets[k] else rows[k][0]) for k in range(len(rows))]
