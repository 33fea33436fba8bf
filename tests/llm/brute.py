"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, a):
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def jaccard_groups(texts):
    """Rows (n_shingles, group) of a list of texts; a group is its first place."""
    sets = [shingles(t) for t in texts]
    groups, held = Groups(range(len(sets))), defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            held[x].append(k)
    shared = Counter((a, b) for own in held.values() for j, b in enumerate(own) for a in own[:j])
    for (a, b), o in shared.items():
        if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
            groups.join(a, b)
    return [(len(s), groups.find(k)) for k, s in enumerate(sets)]


def removed_runs(texts, length=200):
    """Rows (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(x[k : k + length] for x in data for k in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = bytearray(len(x))
        for k in range(len(x) - length + 1):
            if seen[x[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))
        left = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        out.append((len(x), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def without_repeated_lines(rows, run=3):
    """Of (doc_id, text) rows in order: text, lines, removed lines."""
    seen, out = set(), []
    for _, text in rows:
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        full, gone = [k for k, x in enumerate(lines) if x.strip(" ")], set()
        for a in range(len(full) - run + 1):
            window = tuple(lines[k].strip(" ") for k in full[a : a + run])
            if window in seen:
                gone.update(full[a : a + run])
            seen.add(window)
        out.append(("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)))
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """Sources' targets: what is cut goes to the rest until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, cut = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in cut]
        left = total - sum(most * sizes[s] for s in cut)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in cut else share[s] for s in order}
        cut |= above


def _lower(text):
    return [bytes(c + 32 if 65 <= c < 91 else c for c in w) for w in (text or "").encode().split()]


def _discount(counts):
    """Modified Kneser-Ney discounts by count, from a list of all counts."""
    n1, n2, n3, n4 = (sum(1 for c in counts if c == k) for k in (1, 2, 3, 4))
    found = {0: 0.0, 1: 0.5, 2: 1.0, 3: 1.5}
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)):
            if 0 <= d <= k:
                found[k] = d
    return lambda c: found[min(c, 3)]


class KneserNey:
    """An interpolated modified Kneser-Ney trigram model in dictionaries."""

    def __init__(self, texts):
        lines = [["<s>", *_lower(t), "</s>"] for t in texts]
        self.tokens = Counter(w for line in lines for w in line[1:])
        c3 = Counter(x for line in lines for x in zip(line, line[1:], line[2:], strict=False))
        a2 = Counter(x[1:] for x in c3) + Counter((line[0], line[1]) for line in lines)
        a1 = Counter(w for _, w in a2)
        self.levels = []
        for table in ({(w,): n for w, n in a1.items()}, a2, c3):
            d, totals, spare = _discount(list(table.values())), Counter(), Counter()
            for gram, n in table.items():
                totals[gram[:-1]] += n
                spare[gram[:-1]] += d(n)
            self.levels.append((table, d, totals, spare))

    def p(self, context, word):
        out = 1 / (len(self.tokens) + 1)
        for k, (table, d, totals, spare) in enumerate(self.levels):
            own = tuple(context[len(context) - k :])
            if k > len(context) or not totals[own]:
                continue
            n = table.get((*own, word), 0)
            out = (n - d(n)) / totals[own] + spare[own] / totals[own] * out
        return out

    def row(self, text):
        """(n_tokens, n_known, train_tokens, base_score, score)"""
        line, n, v = ["<s>", *_lower(text), "</s>"], sum(self.tokens.values()), len(self.tokens)
        base = sum(math.log10((self.tokens[w] + 0.1) / (n + 0.1 * (v + 1))) for w in line[1:])
        score = sum(math.log10(self.p(line[max(0, k - 2) : k], line[k])) for k in range(1, len(line)))
        return len(line) - 1, sum(1 for w in line[1:] if self.tokens[w]), n, base, score


def _letter_runs(text):
    return re.findall("[A-Za-zÀ-ÿ]+", text or "")


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(words, times=5):
    """Rows (word, form, root, n, n_near, form_n) of a dictionary of counts."""
    forms, near = {}, {}
    for w, n in words.items():
        own = [x for x in words if _near(w, x)]
        near[w] = len(own)
        best = min(own, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= times * n else None

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return sorted((w, forms[w] or "", root(w), n, near[w], words[forms[w]] if forms[w] else 0) for w, n in words.items())


def spelling_words(rows, least=5):
    """Counts of the words of (doc_id, text) rows."""
    total = Counter()
    for doc, text in rows:
        for run in _letter_runs(text):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= least}


def alignments(texts, path_a, path_b):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, sha256) of whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    letters = {c: bytes([k]) for k, c in _byte_letters().items()}
    docs, linked = [], Counter()
    for text in texts:
        docs.append(None)
        if not text:
            continue
        raw = b" " + text.encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        own_a = [b"".join(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        own_b = []
        for i in ids_b:
            p = b.id_to_piece(i)
            own_b.append(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode())
        if b"".join(own_a) != raw or b"".join(own_b) != raw:
            continue
        spans = []
        for own in (own_a, own_b):
            at, found = 0, []
            for x in own:
                found.append((at, at + len(x)))
                at += len(x)
            spans.append(found)
        links = [(i, j) for x, i in zip(spans[0], ids_a, strict=True) for y, j in zip(spans[1], ids_b, strict=True) if x[0] < y[1] and y[0] < x[1]]
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for end in common:
            side = [",".join(str(i) for s, i in zip(span, ids, strict=True) if start < s[1] <= end) for span, ids in zip(spans, (ids_a, ids_b), strict=True)]
            groups.append("|".join(side))
            start = end
        docs[-1] = (len(ids_a), len(ids_b), len(groups), links, ";".join(groups))
        linked.update(set(links))
    top = defaultdict(int)
    for (i, _), n in linked.items():
        top[i] = max(top[i], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links, text = d
        out.append((n_a, n_b, groups, len(links), sum(linked[x] == top[x[0]] for x in links), sum(linked[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


def _byte_letters():
    """The letter that byte-level tokens write for each byte."""
    out, more = {}, 256
    for k in range(256):
        if 33 <= k <= 126 or 161 <= k <= 172 or k >= 174:
            out[k] = chr(k)
        else:
            out[k], more = chr(more), more + 1
    return out
