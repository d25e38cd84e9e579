"""Plain versions of the operators, one row at a time, that the queries are held against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from fractions import Fraction
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op1(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for d, text in docs:
        ids = sp.encode(text or "", add_eos=True)
        out.append((d, len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    return out


def usable(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def op2(vectors, k=10, every=100, scale=1024):
    rows = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in vectors if i is not None and usable(v)]
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for q, v in rows:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in rows if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


ASSIGN = re.compile(r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:o|O)(?:r|R)(?:d|D)|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SECRETS = [("assign", ASSIGN, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


def op3(docs):
    out = []
    for d, text in docs:
        spans = [(m.start(), k, m.end(), kind) for k, (kind, pattern, good) in enumerate(SECRETS) for m in pattern.finditer(text or "") if good(m)]
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        out.append((d, *counts, sha(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)))))
    return out


def op4(docs, limit=2048):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counts = [len(t.encode(text or "", add_special_tokens=False).ids) for _, text in docs]
    return [(d, len((text or "").encode()), n, n > limit) for (d, text), n in zip(docs, counts, strict=True)]


def fingerprint(text: str, shingle: int = 3) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(lower)
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node that can be reached from each."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def op5(docs, bits=3):
    prints = [(d, fingerprint(t or "")) for d, t in docs]
    first = {}
    for d, f in prints:
        if d is not None:
            first[f] = min(d, first.get(f, d))
    keys = sorted(first)
    linked = [(first[a], first[b]) for i, a in enumerate(keys) for b in keys[:i] if (a ^ b).bit_count() <= bits]
    found = components(first.values(), linked)
    return [(d, f"{f:016x}", None if d is None else found[first[f]]) for d, f in prints]


def op6(vectors, k=5, every=50):
    rows = sorted({(i, tuple(map(float, v))) for i, v in vectors if i is not None and usable(v) and any(v)})
    out = []
    wide = max(len(v) for _, v in rows)
    m = np.array([[*v, *[0.0] * (wide - len(v))] for _, v in rows])
    ids = np.array([i for i, _ in rows])
    norms = np.sqrt((m * m).sum(1))
    for n, q in enumerate(ids):
        if q % every == 0:
            score = (m * m[n]).sum(1) / (norms * norms[n])
            scored = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != q)
            out += [(int(q), r + 1, int(i), -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def op8(docs, least=20):
    """``docs`` with unique doc_id."""
    texts = {d: WORD.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(texts):
        for s in range(len(texts[d]) - least + 1):
            first.setdefault(tuple(texts[d][s : s + least]), (d, s))
    out = []
    for d, words in texts.items():
        gone = set()
        for s in range(len(words) - least + 1):
            if first[tuple(words[s : s + least])] != (d, s):
                gone.update(range(s, s + least))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((d, len(words), len(gone), sha(" ".join(kept))))
    return out


def pieces(docs, end=2, length=1024):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for d, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end]
        at, n = 0, len(ids) % length or length
        for k in range(-(-len(ids) // length)):
            out.append((d, k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at, n = at + n, length
    return out


def check_packing(rows, length=1024):
    """rows of (sequence, offset, length): every sequence is gapless from 0 and fits. Returns the number of sequences."""
    by = defaultdict(list)
    for sequence, offset, n in rows:
        by[sequence].append((offset, n))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    return len(by)




LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11(rows):
    """``rows`` of (doc_id, source, lang, n_chars, text). Every node is hashed anew; a fold replaces its child in the whole run."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def climb(levels, at, claim):
        proof = []
        for nodes in levels[:-1]:
            run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
            proof += [d for i, d in enumerate(run) if i != at % 8]
            run[at % 8] = claim
            claim, at = sha("".join(run)), at // 8
        return proof, claim

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(((row[0] is not None, row[0] or 0, leaf(row)), row))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: r[0])
    trees = {g: tree([k[2] for k, _ in groups[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for g in langs:
        for at, ((_, _, digest), row) in enumerate(groups[g]):
            claim = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                claim = (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            low, folded = climb(trees[g], at, leaf(claim))
            high, folded = climb(top, langs.index(g), folded)
            out.append((row[0], digest, trees[g][-1][0], top[-1][0], sha("".join(low + high)), folded, folded == top[-1][0]))
    return out


def mix_targets(sizes, share=(3, 2), weights=(3, 1, 2), most=2):
    """Targets of {source: words}, by sharing what is over a stop again and again, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, targets = Fraction(*share) * sum(sizes.values()), {}
    open_ = set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not above:
            return targets | {s: weight[s] * level for s in open_}
        for s in above:
            targets[s] = Fraction(most * sizes[s])
            left -= targets[s]
        open_ -= above
    return targets


def op12(rows):
    """``rows`` of (doc_id, source, text); the documents of a source are taken in order of their key."""
    docs = [(d, s, len(WORD.findall(t or "")), hashlib.md5(f"{'' if d is None else d}:{t or ''}".encode()).hexdigest()) for d, s, t in rows]
    sizes = defaultdict(int)
    for _, s, n, _ in docs:
        sizes[s] += n
    targets, out = mix_targets(sizes), []
    for source, target in targets.items():
        times = int(target // sizes[source]) if sizes[source] else 0
        budget, upto = target - times * sizes[source], 0
        for d, _, n, _ in sorted((r for r in docs if r[1] == source), key=lambda r: r[3]):
            more = upto + n <= budget or (upto <= budget and 2 * (budget - upto) >= n)
            out.append((d, n, sizes[source], float(target), n * (times + more)))
            upto += n
    return out


def planted(doc_id, words):
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def runs(words, least=12):
    """Runs period by period; words are compared with those a period later, all at once."""
    index, n, found = {}, len(words), {}
    ids = np.array([index.setdefault(w, len(index)) for w in words])
    for q in range(1, n // 2 + 1):
        same = np.flatnonzero(np.diff(np.r_[0, ids[:-q] == ids[q:], 0]))
        for a, b in zip(same[::2].tolist(), same[1::2].tolist(), strict=True):
            if b - a + q >= max(least, 2 * q):
                found.setdefault((a, b - a + q), q)  # the first period of a stretch is its smallest
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def op13(docs):
    out = []
    for d, text in docs:
        words = planted(d, WORD.findall(text or ""))
        own = runs(words)
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in own), default=None)
        longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        out.append((d, len(own), *longest, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return out
