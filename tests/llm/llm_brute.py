"""Plain Python versions of the operators' definitions, for small inputs."""

import re

import xxhash

MASK = (1 << 64) - 1


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", lower_ascii(text or ""))


def simhash(text, n=3):
    w = words(text)
    parts = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def weighted_simhash(text):
    w = words(text)
    terms = [(t, len(t)) for t in w] + [(f"{a} {b}", len(a) + len(b) + 1) for a, b in zip(w, w[1:])]
    hashed = [(xxhash.xxh64_intdigest(t.encode(), seed=42), n) for t, n in terms]
    total = sum(n for _, n in hashed)
    return sum(1 << b for b in range(64) if 2 * sum(n for h, n in hashed if h >> b & 1) > total)


def bits(a, b):
    return ((a ^ b) & MASK).bit_count()


def components(prints, most=2):
    """{doc_id: least doc_id reachable} for {doc_id: fingerprint}."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in ids:
        for y in ids:
            if y < x and bits(prints[x], prints[y]) <= most:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & MASK
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b
