r"""Personal data by anchor expansion (op 7).

One Aho-Corasick pass over each text finds anchors: at-signs, URL schemes, a plus or a dot before a digit,
digit pairs and identifier cues. From an anchor a deterministic local parser widens to the largest
zone of characters that its kind allows, and parses and validates inside it, once and forwards. Every match of a kind
consists of such characters and holds an anchor, so parsing zones from left to right gives the leftmost
non-overlapping matches of the whole text, in time that is linear in its length.

Kinds: email, ip (four parts of at most 255), card (12 to 19 digits, Luhn), phone (9 to 15 digits). Beside
them url_login (user and password before the at-sign of a URL) and account (a cue such as "iban"
or "account no" before 8 or more digits or letters), which never replace a base span.

Null and empty texts have no spans; repeated rows are treated alike; of spans with the same start the order
is that of the kinds as listed; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.runtime import limit_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url_login", "account")
RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

# The patterns that define the base kinds, and the characters that they can hold.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALLOWED = {
    "email": frozenset(LETTERS + LETTERS.upper() + DIGITS + "._%+-@"),
    "ip": frozenset(DIGITS + "."),
    "card": frozenset(DIGITS + " -"),
    "phone": frozenset(DIGITS + "+ ().-"),
}
CUES = ("iban", "account no", "account number", "acct", "passport no", "ssn")


DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
RUN_OF_DIGITS = re.compile(r"[0-9]+")


def emails(text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    """Matches in a zone: what stands between the last match, or at-sign, and an at-sign, and the domain after it."""
    start, at = a, text.find("@", a, b)
    while at >= 0:
        after = text.find("@", at + 1, b)
        domain = DOMAIN.match(text, at + 1, b if after < 0 else after) if at > start else None
        if domain:
            yield start, domain.end()
        start, at = domain.end() if domain else at + 1, after


def addresses(text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    """Matches in a zone of digits and dots: every four runs of digits in a row that have one dot between them."""
    held: list[int] = []
    end = a
    for m in RUN_OF_DIGITS.finditer(text, a, b):
        held = [*held, m.start()] if held and m.start() == end + 1 else [m.start()]
        end = m.end()
        if len(held) == 4:
            yield held[0], end
            held = []


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if c in DIGITS)


def valid(kind: str, s: str) -> bool:
    if kind == "ip":
        return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in s.split("."))
    if kind == "card":
        d = only_digits(s)
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(only_digits(s)) <= 15
    return True


class AnchorScanner:
    """The automaton and the local parsers; one per Python worker."""

    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        anchors: dict[str, set[str]] = {"@": {"email"}}
        for d in DIGITS:
            anchors.setdefault("." + d, set()).add("ip")
            anchors.setdefault("+" + d, set()).add("phone")
            for between in ("", " ", "-"):
                for e in DIGITS:
                    anchors.setdefault(d + between + e, set()).add("card")
        anchors["://"] = {"url_login"}
        for cue in CUES:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                anchors[form] = {"account"}
        for text, kinds in anchors.items():
            self.automaton.add_word(text, (len(text), tuple(sorted(kinds))))
        self.automaton.make_automaton()
        found_by = lambda p: lambda text, a, b: (m.span() for m in p.finditer(text, a, b))  # noqa: E731 - nothing in these two can be read twice
        self.parsers = {"email": emails, "ip": addresses, **{k: found_by(re.compile(PATTERNS[k])) for k in ("card", "phone")}}
        self.left = {k: re.compile("[" + re.escape("".join(sorted(a))) + "]+") for k, a in ALLOWED.items()}
        self.login = re.compile(r"[^\s/?#@:\"'<>]+:[^\s/?#@\"'<>]+@")
        self.number = re.compile(r"[\x20:.#=-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}|[0-9](?:[\x20-]?[0-9]){7,33})")

    def zone(self, kind: str, text: str, at: int) -> tuple[int, int]:
        """The largest run of the kind's characters around position at."""
        allowed, i = ALLOWED[kind], at
        while i > 0 and text[i - 1] in allowed:
            i -= 1
        return i, self.left[kind].match(text, at).end()

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, index into KINDS, end) of all spans, in order."""
        if not text:
            return []
        out: list[tuple[int, int, int]] = []
        done = dict.fromkeys(KINDS, 0)
        for end, (size, kinds) in self.automaton.iter(text):
            start = end - size + 1
            for kind in kinds:
                if start < done[kind]:
                    continue
                if kind == "url_login":
                    if m := self.login.match(text, end + 1):
                        out.append((m.start(), KINDS.index(kind), m.end() - 1))
                        done[kind] = m.end()
                elif kind == "account":
                    if m := self.number.match(text, end + 1):
                        out.append((m.start(1), KINDS.index(kind), m.end(1)))
                        done[kind] = m.end()
                else:
                    a, b = self.zone(kind, text, start)
                    for i, j in self.parsers[kind](text, a, b):
                        if valid(kind, text[i:j]):
                            out.append((i, KINDS.index(kind), j))
                    done[kind] = b
        return sorted(out)

    def report(self, text: str | None) -> tuple:
        found = self.spans(text)
        say = lambda s: f"{KINDS[s[1]]}:{s[0]}:{s[2]}"
        base = [s for s in found if s[1] < len(BASE)]
        counts = [sum(s[1] == k for s in base) for k in range(len(BASE))]
        return (*counts, hashlib.sha256(",".join(map(say, base)).encode()).hexdigest(), ",".join(map(say, found)))


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first stays."""
    if text is None:
        return None
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
            at = end
    return "".join([*out, text[at:]])


def personal_data(text: Column) -> Column:
    """struct of RESULT for a text column."""

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = AnchorScanner()
        for texts in batches:
            yield pd.DataFrame([scanner.report(t) for t in texts], columns=[c.split()[0] for c in RESULT.split(", ")])

    return scan(text)


def redacted(text: Column) -> Column:
    """The text column with every span replaced by its kind."""

    @F.pandas_udf("string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = AnchorScanner()
        for texts in batches:
            yield pd.Series([redact(t, scanner.spans(t)) for t in texts], dtype=object)

    return scan(text)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and RESULT for every row of docs."""
    limit_batches(docs.sparkSession)
    return docs.select("doc_id", personal_data(F.col("text")).alias("p")).select("doc_id", "p.*")
