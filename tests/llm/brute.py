"""Plain definitions that tests compare with."""

import re

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def brute(rows):
    """(id, size, least id reachable) by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(x for x in (least.get(find(i)), d) if x is not None) if (d is not None or find(i) in least and least[find(i)] is not None) else None
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)
