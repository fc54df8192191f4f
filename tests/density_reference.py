"""Plain density clustering on all pairs, top-down over a binary dendrogram."""

import numpy as np


def mutual_reachability(x, min_samples):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, min(min_samples, len(x) - 1)]
    m = np.maximum(np.maximum(d, core[:, None]), core[None, :])
    np.fill_diagonal(m, 0)
    return d, core, m


def tree_edges(m):
    """Prim on the full matrix."""
    n = len(m)
    inside, best, source, edges = {0}, m[0].copy(), np.zeros(n, int), []
    best[0] = np.inf
    while len(inside) < n:
        j = int(np.argmin(best))
        edges.append((best[j], int(source[j]), j))
        inside.add(j)
        best[j] = np.inf
        for i in range(n):
            if i not in inside and m[j, i] < best[i]:
                best[i], source[i] = m[j, i], j
    return sorted(edges)


def cluster(x, min_cluster_size, min_samples, floor=1e-10):
    _, _, m = mutual_reachability(x, min_samples)
    n = len(x)
    node, left, right, height, members = list(range(n)), {}, {}, {}, {i: [i] for i in range(n)}
    owner = list(range(n))
    following = n
    for w, a, b in tree_edges(m):
        left[following], right[following], height[following] = owner[a], owner[b], w
        members[following] = members[owner[a]] + members[owner[b]]
        for p in members[following]:
            owner[p] = following
        following += 1
    root = following - 1
    clusters = {0: {"birth": 0.0, "exits": {}, "children": [], "parent": None}}

    def walk(start, start_cluster):
        stack = [(start, start_cluster)]
        while stack:
            v, c = stack.pop()
            if v < n:
                continue
            lam = 1 / max(height[v], floor)
            l, r = left[v], right[v]
            big = [u for u in (l, r) if len(members[u]) >= min_cluster_size]
            if len(big) == 2:
                for u in big:
                    k = len(clusters)
                    clusters[k] = {"birth": lam, "exits": {}, "children": [], "parent": c, "size": len(members[u])}
                    clusters[c]["children"].append((k, lam))
                    stack.append((u, k))
            else:
                for u in (l, r):
                    if u in big:
                        stack.append((u, c))
                    else:
                        for p in members[u]:
                            clusters[c]["exits"][p] = lam
    walk(root, 0)
    value, flag = {}, {}
    for k in sorted(clusters, reverse=True):
        c = clusters[k]
        own = sum(lam - c["birth"] for lam in c["exits"].values())
        own += sum(clusters[j]["size"] * (lam - c["birth"]) for j, lam in c["children"])
        inner = sum(value[j] for j, _ in c["children"])
        flag[k] = k != 0 and own >= inner - 1e-9 * abs(inner)
        value[k] = own if flag[k] else inner
    labels, probs = np.full(n, -1), np.zeros(n)
    # A row that joins in the very step in which two clusters join may be
    # counted to one of them (binary steps) or to their union (one step).
    tied = {p for c in clusters.values() for p, lam in c["exits"].items() if lam == c["birth"]}

    def top(k):
        found = None
        while k is not None:
            if flag[k]:
                found = k
            k = clusters[k]["parent"]
        return found

    for k, c in clusters.items():
        t = top(k)
        if t is None:
            continue
        peak = max(list(clusters[t]["exits"].values()) + [lam for _, lam in clusters[t]["children"]])
        for p, lam in c["exits"].items():
            labels[p], probs[p] = t, min(lam, peak) / peak
    return labels, probs, tied
