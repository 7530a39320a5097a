"""Plain versions of the operators, over lists, for the tests."""

import hashlib
import re
import struct
from collections import Counter
from itertools import accumulate

import public_tokenizers
import sentencepiece
import xxhash
from tokenizers import Tokenizer

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(codes, tau=3):
    """The index of the first member of each code's component."""
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= tau:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def words10(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def hits(text, items, width=10):
    doc, marks, met = words10(text), set(), set()
    for item, body in items:
        own = words10(body)
        n = min(width, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1):
            if n and tuple(doc[i : i + n]) in grams:
                marks.update(range(i, i + n))
                met.add(str(item))
    return len(doc), len(marks), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(marks)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def near_texts(texts, tau=11):
    """The index of the first member of each text's group: fingerprints within tau bits and a Jaccard similarity of 0.8."""
    codes, sets, parent = [simhash(t) for t in texts], [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (codes[i] ^ codes[j]).bit_count() <= tau and 5 * len(a & b) >= 4 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def split(total, kids):
    """A total split among kids {name: (weight, supply)} by weight; what one lacks goes to the others, in whole tokens."""
    given, left = {}, total
    open_ = {k: v for k, v in kids.items() if v[0] > 0 and v[1] > 0}
    while open_:
        whole = sum(w for w, _ in open_.values())
        full = [k for k, (w, s) in open_.items() if s <= left * w / whole]
        if not full:
            break
        for k in full:
            given[k] = open_.pop(k)[1]
            left -= given[k]
    exact = {k: left * w / sum(v for v, _ in open_.values()) for k, (w, _) in open_.items()}
    given |= {k: int(x) for k, x in exact.items()}
    spare = left - sum(int(x) for x in exact.values())
    for k in sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))[:spare]:
        given[k] += given[k] < open_[k][1]
    return given


def budgets(leaves, total, weight, epochs):
    """Budgets of {path: tokens}, level by level."""

    def below(path, total):
        depth = len(path)
        names = {p[depth] for p in leaves if p[:depth] == path}
        kids = {n: (weight((*path, n)), epochs * sum(t for p, t in leaves.items() if p[: depth + 1] == (*path, n))) for n in names}
        for n, share in split(total, kids).items():
            if depth == 2:
                out[(*path, n)] = share
            else:
                below((*path, n), share)

    out = {}
    below((), total)
    return out


def draw(doc_id, text, epoch, seed=11):
    """The place of a document in its leaf's order: XXH64 chained over text, id, epoch and seed, without its last bit."""
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    h = h - (1 << 64) if h >> 63 else h
    out = 42
    for x, form in ((doc_id, "<q"), (h, "<q"), (epoch, "<i"), (seed, "<i")):
        if x is not None:
            out = xxhash.xxh64_intdigest(struct.pack(form, x), out)
    return out >> 1


def mixed(rows, total, weight, epochs, tokens):
    """Selected (index, epoch) of rows (doc_id, text, domain, lang, source)."""
    leaves = {}
    for i, r in enumerate(rows):
        leaves.setdefault(tuple(x or "" for x in r[2:5]), []).append(i)
    sizes = {p: sum(tokens[i] for i in own) for p, own in leaves.items()}
    given, out = budgets(sizes, total, weight, epochs), []
    for path, own in leaves.items():
        for e in range(epochs):
            room, at, last = min(sizes[path], given.get(path, 0) - e * sizes[path]), 0, None
            for i in sorted(own, key=lambda i: draw(rows[i][0], rows[i][1], e)):
                if at < room or room > 0 and draw(rows[i][0], rows[i][1], e) == last:
                    out.append((i, e))
                    last = draw(rows[i][0], rows[i][1], e)
                at += tokens[i]
    return sorted(out)


def tokens_of(texts):
    """Functions that give (id, bytes) of a text's tokens on both sides of the alignment."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}

    def left(x):
        return [(i, bytes(back[c] for c in t.id_to_token(i))) for i in t.encode(" " + x, add_special_tokens=False).ids]

    def right(x):
        return [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("\u2581", " ").encode()) for i in sp.encode(x)]

    return left, right


def aligned(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text, from byte offsets."""
    left, right = tokens_of(texts)
    rows, links, counts = [], [], Counter()
    for x in texts:
        own, sides = [], [left(x), right(x)] if x else [[], []]
        if not x or any(b"".join(b for _, b in side) != (" " + x).encode() for side in sides):
            rows.append((0, 0, 0, 0, ""))
            links.append(own)
            continue
        spans = [[(end - len(b), end, i) for end, (i, b) in zip(accumulate(len(b) for _, b in side), side)] for side in sides]
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = ["|".join(",".join(str(i) for s, e, i in side if e > a and e <= b) for side in spans) for a, b in zip([0, *cuts], cuts)]
        own += [(i, j) for s, e, i in spans[0] for p, q, j in spans[1] if max(s, p) < min(e, q)]
        counts.update(own)
        rows.append((len(sides[0]), len(sides[1]), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    best = {j: max(n for (_, k), n in counts.items() if k == j) for _, j in counts}
    return [(*r[:4], sum(counts[x] == best[x[1]] for x in own), sum(counts[x] for x in own), r[4]) for r, own in zip(rows, links)]


def linked(texts, least=(85, 100)):
    """The index of the first member of each text's group, and set sizes: five-word shingles; texts without words stand alone."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if a and b and least[1] * len(a & b) >= least[0] * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    return root, [len(s) for s in sets]


def phrases(rows, least=10, cover=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    cands = [k for k, a in f.items() if len(k[1]) > 1 and a >= least]
    out = []
    for lang in n:
        own = []
        for _, p in (c for c in cands if c[0] == lang):
            a = f[lang, p]
            if any(q[0] == lang and len(q[1]) > len(p) and p in (q[1][:2], q[1][1:]) and 100 * f[q] >= cover * a for q in cands):
                continue
            score, _, left, right = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            own.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1)]
    return out
