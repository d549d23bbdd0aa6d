"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import regex

from moraflow.llm.decontamination import UNITS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def suffix_dedup(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def window_dedup(rows, width=20):
    """For distinct, non-null ids."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][k : k + width]), (i, k))
    out = []
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < (i, k):
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept.encode())))
    return out


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def shingle_groups(rows, percent=75):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, r in sets[a + 1 :]:
            if s and r and 100 * len(s & r) >= percent * len(s | r):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, len(s), find(i)) for i, s in sets]


def spans(text, patterns, accept):
    found = [(m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, text or "") if accept(k, m)]
    return sorted(found)


def listing(found, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PII = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def pii(text):
    def accept(k, m):
        digits = re.sub("[^0-9]", "", m[0])
        if k == 1:
            return all(int(p) <= 255 for p in m[0].split("."))
        if k == 2:
            return 14 <= len(digits) <= 19 and luhn(digits)
        return k == 0 or 10 <= len(digits) <= 15

    return spans(text, PII, accept)


SECRETS = [
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    r"AKIA[A-Z0-9]+",
    r"[0-9a-f]+",
]


def secrets(text):
    return spans(text, SECRETS, lambda k, m: len(m[1]) >= 12 if k == 0 else len(m[0]) >= (18, 16)[k - 1])


def line_dedup(rows, least=40, docs=5):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(strip))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= docs and max(held[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return out


def top_products(rows, k=5):
    import math

    vecs = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in vecs:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vecs if i != q and len(v) == len(w))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def product_codes(rows: list[tuple], parts: int = 16, entries: int = 64, rounds: int = 2) -> list[tuple]:
    """(id, code, error, label_error, codebook digest) of (id, vector, label) rows, every distance computed."""
    kept = [(i, [math.floor(256 * float(c)) for c in x], label) for i, x, label in rows if x and all(c is not None and math.isfinite(c) for c in x)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cuts = [[tuple(x[p * width : (p + 1) * width]) for p in range(parts)] for _, x, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    book = [[cuts[k][p] for k in first] for p in range(parts)]
    near = lambda x, p: min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book[p]))
    for _ in range(rounds):
        members = {}
        for cut in cuts:
            for p, x in enumerate(cut):
                members.setdefault((p, near(x, p)[1]), []).append(x)
        for (p, e), held in members.items():
            book[p][e] = tuple(sum(c) // len(held) for c in zip(*held))
    digest = sha(",".join(str(c) for p in book for e in p for c in e).encode())
    coded = [[near(x, p) for p, x in enumerate(cut)] for cut in cuts]
    errors = [sum(d for d, _ in c) for c in coded]
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    return [(i, "".join(f"{e:02x}" for _, e in c), error, by_label[label], digest) for (i, _, label), c, error in zip(kept, coded, errors)]


def _tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 8]).encode()) for k in range(0, len(levels[-1]), 8)])
    return levels


def manifest(rows: list[tuple]) -> list[tuple]:
    """Rows of op13 for (doc_id, source, lang, n_chars, text), the tree built whole and each proof folded level by level."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    hashed = lambda row: sha("".join(map(part, row)).encode())
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, hashed(r)))
        trees[g] = _tree([hashed(r) for r in groups[g]])
    top = _tree([trees[g][-1][0] for g in langs])
    out = []
    for place, g in enumerate(langs):
        for at, row in enumerate(groups[g]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = hashed((*row[:4], row[4].translate(LOWER) if row[4] is not None else None)) if tampered else trees[g][0][at]
            proof = ""
            for tree, k in ((trees[g], at), (top, place)):
                for level in tree[:-1]:
                    start = k - k % 8
                    before, after = "".join(level[start:k]), "".join(level[k + 1 : start + 8])
                    proof, node, k = proof + before + after, sha((before + node + after).encode()), k // 8
            out.append((row[0], trees[g][0][at], trees[g][-1][0], top[-1][0], sha(proof.encode()), node, node == top[-1][0]))
    return out


def _tokens(text: str | None) -> list[str]:
    """Tokens of the template canonicalisation, by patterns of the `regex` module."""
    typed = regex.sub(rf"([0-9]+(?:[.,][0-9]+)*)(?:\x20?({UNITS})\b)?", lambda m: f" #n{m[1]} #u{m[2] or ''} ", (text or "").replace("#", " "), flags=regex.ASCII)
    named = regex.sub(r"(?<=[\p{Ll},;:]\x20)(\p{Lu}\p{L}+)", r"#a\1", typed).lower()
    return [t for t in regex.split(r"(?:[^\p{L}\p{N}#.,]|[.,](?![0-9]))+", named) if t]


def held_items(docs, items, width=6, enough=24):
    """(doc, item) where windows on one diagonal cover enough of the item and their slots map one to one."""
    shape = lambda w, k: tuple(t[:2] if t[0] == "#" else t for t in w[k : k + width])
    at = defaultdict(list)
    tokens = [(i, _tokens(t)) for i, t in items]
    for n, (_, w) in enumerate(tokens):
        for k in range(len(w) - width + 1):
            at[shape(w, k)].append((n, k))
    out = set()
    for doc, text in docs:
        w, lines = _tokens(text), defaultdict(dict)
        for k in range(len(w) - width + 1):
            for n, j in at.get(shape(w, k), ()):
                lines[n, k - j][k] = j
        for (n, _), met in lines.items():
            item, theirs = tokens[n]
            pairs = {(theirs[j + o], w[k + o]) for k, j in met.items() for o in range(width) if w[k + o][0] == "#"}
            if len(met) + width - 1 >= min(-(-len(theirs) // 2), enough) and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                out.add((doc, item))
    return out
