"""Byte-level BPE encoding by backtracking, and decoding by an offset table.

A piece of pre-split text is encoded without running merges: an Aho-Corasick automaton over the vocabulary gives the
longest token at every place of the piece, and tokens are laid from left to right. A token may follow another only if
the two are compatible, that is if no merge across their border would come before the merges that build them; the
answer for each pair is kept in a table. Where no token fits, the last one is taken back and a shorter one tried, and
places known to be dead ends are not entered again, so the work is linear in the piece. Sequences of compatible
neighbours are exactly what the merges give.

Decoding gathers bytes from one blob of all tokens by offset and length. The vocabulary's path is a parameter; the file
must be on every node. Each task keeps the ids of pieces that it has met, up to twice MEMO of them.

Defined cases: a null or empty text has no ids; the strings of special tokens are single ids, as in the library.
"""

import hashlib
import json

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from moraflow.llm.texts import keyed, per_text, public_id

MEMO = 200_000
GATHER = 1 << 16  # ids decoded at once
#: Fixed value: the pattern that this kind of vocabulary splits text by, \s written as the Unicode property.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
NEVER = 1 << 60


def byte_of_char() -> dict[str, int]:
    """Vocabulary files write bytes as characters: visible Latin-1 ones as themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Memo(dict):
    """Ids of a piece as packed bytes; a missing piece is encoded. When full, pieces not used since the last time go."""

    def __init__(self, encode):
        self.encode, self.before = encode, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(piece)
        if ids is None:
            ids = np.array(self.encode(piece.encode()), dtype="<u4").tobytes()
        self[piece] = ids
        return ids


class Tokenizer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        code = byte_of_char()
        raw = lambda token: bytes(code[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.bytes = {i: raw(t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.rank, self.parts, self.made_at = {}, {}, {}
        for r, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            whole, pair = vocab[left + right], (vocab[left], vocab[right])
            self.rank[pair] = r
            self.parts.setdefault(whole, pair)
            self.made_at.setdefault(whole, r)
        made = [i for i in vocab.values() if i in self.parts or len(self.bytes[i]) == 1]
        self.automaton = ahocorasick.Automaton()
        for i in made:
            self.automaton.add_word(self.bytes[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.length = {i: len(self.bytes[i]) for i in made}
        by_bytes = {self.bytes[i]: i for i in made}
        self.shorter = {i: self._longest_prefix(self.bytes[i], by_bytes) for i in made}
        self.compatible: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.split = regex.compile(SPLIT)
        self.special_at = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.memo = Memo(self.encode_piece)
        size = max(self.bytes) + 1
        self.blob = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.lengths = np.array([len(self.bytes.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    @staticmethod
    def _longest_prefix(token: bytes, by_bytes: dict[bytes, int]) -> int | None:
        return next((by_bytes[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in by_bytes), None)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stood at one end of `token` while it was built, each with the rank that consumed it."""
        out = self.spines[side].get(token)
        if out is None:
            out, until, part = [], NEVER, token
            while True:
                out.append((part, until))
                if part not in self.parts:
                    break
                until, part = self.made_at[part], self.parts[part][side]
            self.spines[side][token] = out
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether merges over both tokens' bytes leave the border between them; at equal ranks the left merge is first."""
        rank = self.rank
        starts = self._spine(right, 0)
        for x, gone_x in self._spine(left, 1):
            for y, gone_y in starts:
                r = rank.get((x, y))
                if r is not None and r < gone_x and r <= gone_y:
                    return False
        return True

    def encode_piece(self, piece: bytes) -> list[int]:
        length, size = self.length, len(piece)
        longest = [-1] * size
        for last, token in self.automaton.iter(piece.decode("latin-1")):
            start = last + 1 - length[token]  # matches that end later are longer
            longest[start] = token
        if size and length[longest[0]] == size:
            return [longest[0]]
        compatible, shorter = self.compatible, self.shorter
        out: list[int] = []
        dead = set()
        at, token, before = 0, longest[0] if size else None, None
        while at < size:
            while token is not None:
                end = at + length[token]
                if end not in dead:
                    if before is None:
                        break
                    known = compatible.get(pair := before << 32 | token)
                    if known is None:
                        if len(compatible) >= 2 * MEMO:
                            compatible.clear()
                        known = compatible[pair] = self.fits(before, token)
                    if known:
                        break
                token = shorter[token]
            if token is None:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]
            else:
                out.append(token)
                at = end
                token = longest[at] if at < size else None
            before = out[-1] if out else None
        return out

    def encode(self, text: str) -> np.ndarray:
        parts, at = [], 0
        memo = self.memo.__getitem__
        for m in self.special_at.finditer(text) if self.special_at else ():
            parts += map(memo, self.split.findall(text[at : m.start()]))
            parts.append(np.array([self.special[m[0]]], dtype="<u4").tobytes())
            at = m.end()
        parts += map(memo, self.split.findall(text[at:] if at else text))
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        out = []
        for k in range(0, len(ids), GATHER):
            part = ids[k : k + GATHER]
            sizes = self.lengths[part]
            ends = np.cumsum(sizes)
            places = np.repeat(self.offsets[part] - ends + sizes, sizes)
            places += np.arange(len(places))
            out.append(self.blob[places].tobytes())
        return b"".join(out).decode("utf-8", errors="replace")


def _answer(path: str):
    def make():
        tokenizer = Tokenizer(path)
        decimal = [str(i) for i in range(len(tokenizer.lengths))]

        def answer(text: str) -> tuple:
            ids = tokenizer.encode(text)
            listed = ",".join(map(decimal.__getitem__, ids.tolist()))
            back = tokenizer.decode(ids)
            return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

        return answer

    return make


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of `docs`."""
    found = per_text(keyed(docs, id_col, text_col), _answer(path), "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.select(public_id().alias("doc_id"), *found.columns[1:])


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for every row of `docs`."""

    def make():
        tokenizer = Tokenizer(path)
        return lambda text: (tokenizer.encode(text).tolist(),)

    found = per_text(keyed(docs, id_col, text_col), make, "ids array<int>")
    return found.select(public_id().alias("doc_id"), "ids")
