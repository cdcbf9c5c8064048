"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

UPPER = {i: i + 32 for i in range(65, 91)}


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def decontaminated(texts, items, n=10):
    """(n_words, n_hit, n_items, sha, contaminated) of each text."""
    windows = defaultdict(set)
    for item, text in items:
        w = benchmark_words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i:i + size])].add(item)
    out = []
    for text in texts:
        w, hit, found = benchmark_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if got := windows.get(tuple(w[i:i + size])):
                    found |= got
                    hit.update(range(i, i + size))
        named = sorted(str(x) for x in found if x is not None)
        out.append((len(w), len(hit), len(named), sha(",".join(named)), bool(hit)))
    return out


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard(docs):
    """{id: (n_shingles, component)} of (id, text)."""
    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    found = components(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


SECRETS = [
    (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
     r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("AKIA[A-Z0-9]+", 0, 16), ("[0-9a-f]+", 0, 32)]


def secrets(text):
    return sorted((m.start(), kind, m.end()) for kind, (p, group, least) in enumerate(SECRETS)
                  for m in re.finditer(p, text or "") if len(m[group]) >= least)
