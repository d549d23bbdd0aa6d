"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and identifier cues. At each
anchor a small parser with one possible reading expands left and right, and a validator accepts or rejects what it
found. Every parser keeps the place where its kind resumes, so matches of a kind never overlap and each character is
read a bounded number of times. A text of any length needs memory for itself and its spans only.

Kinds: email, ip, card and phone are the base. The method adds `url` (a scheme with a host) and `account` (a cue such as
"iban" or "account no" with a number of at least six digits behind it, IBAN check digits verified where it is one).

Defined cases: a null text is empty and has no spans; offsets are code points, ends exclusive.
"""

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame

from moraflow.llm.texts import keyed, per_text, public_id

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
DIGITS = "0123456789"
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("iban", "account", "acct", "passport", "ssn")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
RUN = re.compile(r"[0-9]+")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIAL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:/[^\x00-\x20\"'<>]*)?")
NUMBER = re.compile(r"(?:\x20?(?:no|number|nr)\.?)?[\x20:#=]{1,3}([A-Za-z]{0,2}[0-9][A-Za-z0-9]{5,33})", re.ASCII | re.IGNORECASE)
NOT_DIGIT = re.compile(r"[^0-9]")


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    words = [("@", "@"), ("+", "+"), *((d, "0") for d in DIGITS), *((s, "url") for s in SCHEMES)]
    words += [(form, "cue") for cue in CUES for form in {cue, cue.capitalize(), cue.upper()}]
    for word, kind in words:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Each second digit from the right is doubled, and its digits added."""
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def iban(value: str) -> bool:
    turned = (value[4:] + value[:4]).upper()
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def scanner():
    """Function from a text to its spans (start, place of the kind in KINDS, end), in that order."""
    automaton = anchors()

    def scan(text: str) -> list[tuple[int, int, int]]:
        spans = []
        email_from = quad_from = chain_from = dial_from = url_from = number_from = 0
        for last, (kind, length) in automaton.iter(text):
            at = last - length + 1
            if kind == "0":
                if at >= quad_from:
                    if m := QUAD.match(text, at):
                        quad_from = m.end()
                        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                            spans.append((at, 1, quad_from))
                    else:
                        quad_from = RUN.match(text, at).end()
                if at >= chain_from and (m := CHAIN.match(text, at)):
                    chain_from = m.end()
                    digits = NOT_DIGIT.sub("", m[0])
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        spans.append((at, 2, chain_from))
            elif kind == "@":
                start = at
                while start > email_from and text[start - 1] in LOCAL:
                    start -= 1
                if start < at and (m := DOMAIN.match(text, at + 1)):
                    email_from = m.end()
                    spans.append((start, 0, email_from))
            elif kind == "+":
                if at >= dial_from and (m := DIAL.match(text, at)):
                    dial_from = m.end()
                    if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                        spans.append((at, 3, dial_from))
            elif kind == "url":
                if at >= url_from and (m := HOST.match(text, last + 1)):
                    url_from = m.end()
                    spans.append((at, 4, url_from))
            elif at >= number_from and not (at and text[at - 1].isalnum()) and (m := NUMBER.match(text, last + 1)):
                value = m[1]
                number_from = m.end()
                looks_iban = value[:2].isalpha() and value[2:4].isdigit() and len(value) >= 15
                if iban(value) if looks_iban else sum(c.isdigit() for c in value) >= 6:
                    spans.append((m.start(1), 5, number_from))
        return sorted(spans)

    return scan


def listing(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def _answer():
    scan = scanner()

    def answer(text: str) -> tuple:
        spans = scan(text)
        base = [s for s in spans if s[1] < len(BASE_KINDS)]
        counts = [sum(s[1] == k for s in base) for k in range(len(BASE_KINDS))]
        return *counts, hashlib.sha256(listing(base).encode()).hexdigest(), listing(spans)

    return answer


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of `docs`."""
    found = per_text(
        keyed(docs, id_col, text_col), _answer, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
    return found.select(public_id().alias("doc_id"), *found.columns[1:])
