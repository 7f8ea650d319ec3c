"""Plain forms of the operators, for small inputs."""


def edit_distance(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def groups(nodes, links):
    """The least node reachable from each node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def periodic_runs(words, least=24, periods=3):
    """Start, length and period of every maximal stretch of a smallest period, straight from the definition."""
    n, found = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            smallest = next(p for p in range(1, q + 1) if all(stretch[k] == stretch[k + p] for k in range(len(stretch) - p)))
            if smallest == q and len(stretch) >= max(least, periods * q):
                found.append((i, len(stretch), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {k for start, length, period in runs for k in range(start + period, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)
