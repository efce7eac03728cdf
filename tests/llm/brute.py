"""Plain definitions that the operators are compared with (small inputs only)."""

import base64
import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) >= width:
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def near_dup(docs, width):
    """{doc_id: (n_shingles, component_id)} over (doc_id, text) with unique ids."""
    sets = {d: shingles(t, width) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    for d in sorted(sets):
        for e, both in Counter(e for x in sets[d] for e in by[x] if e > d).items():
            if 100 * both >= 80 * (len(sets[d]) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def line_dedup(docs):
    """{doc_id: (n_lines, n_dropped, kept text)} over (doc_id, text)."""
    ws = " \t\n\x0b\x0c\r"
    keys = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            k = line.strip(ws).translate(LOWER)
            if len(k) >= 10:
                keys.setdefault(k, set()).add(d)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(of := keys.get(x.strip(ws).translate(LOWER), ())) > 1 and min(of) != d)]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def copies(docs, seed="mix"):
    """{doc_id: (size, source_size, target, copies)} over (doc_id, source, text)."""
    size = {d: len(WORD.findall(t or "")) for d, _, t in docs}
    per = Counter()
    for d, s, _ in docs:
        per[s] += size[d]
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(per.values())
    while True:
        rest = [s for s in names if s not in capped]
        left = total - 3 * sum(per[s] for s in capped)
        w = sum(weight[s] for s in rest)
        target = {s: 3 * per[s] if s in capped else weight[s] * left / w for s in names}
        over = {s for s in rest if target[s] >= 3 * per[s] - 1e-9}
        if not over:
            break
        capped |= over
    out = {}
    for d, s, _ in docs:
        rate = target[s] / per[s] if per[s] else 0.0
        coin = int(hashlib.md5(f"{seed}:{'null' if d is None else d}".encode()).hexdigest()[:12], 16) / 2 ** 48
        out[d] = (size[d], per[s], target[s], math.floor(rate) + (coin < rate - math.floor(rate)))
    return out


def tiktoken_encoding():
    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
