"""Personal data in texts: fixed patterns for four kinds, and a CRF over word shapes for the forms they miss.

The patterns are the base; their spans always stay. The tagger is trained from a small labelled table that
:func:`labelled_table` states by rule (carrier words around written-out forms of each kind, and look-alikes that are
none), and adds spans that overlap no base span: national phone numbers, addresses with ``(at)`` or ``[dot]``, cards
in dotted groups.

Defined results: a null or empty text has no spans; every input row gives one output row, repeated ids included; an
empty table gives an empty result; other columns are not read. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from .tagger import Tagger, fit_tagger, length_class, shape
from .texts import per_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A failing start inside a run of digits fails from each later digit of the run too, so starts are held to run starts.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Shapes of words in lower case, capitalised or in upper case.
_WORDS = frozenset({"a", "Aa", "A"})


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ so that long runs without one cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_RUN:
            start -= 1
        rest = _DOMAIN.match(text, at + 1) if start < at else None
        if rest:
            done = rest.end()
            yield start, done
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return in_order(found, KINDS)


def in_order(spans: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], kinds.index(x[0]), x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _own(token: str) -> list[str]:
    bare = token.strip(".,;:!?\"'")
    n = sum(c.isdigit() for c in token)
    return [
        shape(bare), length_class(bare), f"d{min(n, 20)}", f"@{'@' in bare}", f"q{bare.count('.')}",
        f"l{12 <= n <= 19 and luhn(_digits(bare))}", bare.lower() if bare.lower() in _CUES else "-",
    ]


def _near(token: str) -> list[str]:
    bare = token.strip(".,;:!?\"'")
    n = sum(c.isdigit() for c in token)
    return [shape(bare)[:6] if n or bare.lower() in _CUES else "word", f"d{min(n, 8)}", bare.lower() if bare.lower() in _CUES else "-"]


#: Written-out parts of an address, as fixed values.
_CUES = frozenset({"(at)", "[at]", "(dot)", "[dot]"})


@lru_cache(maxsize=1 << 16)
def is_plain(token: str) -> bool:
    """Whether ``PLAIN_FORMS`` holds a word with the same features: letters only, in a usual case, shorter than 24."""
    bare = token.strip(".,;:!?\"'")
    return bare.isalpha() and len(bare) < 24 and (bare.islower() or shape(bare) in _WORDS)


def labelled_table(seed: int = 7, rows: int = 450) -> list[list[tuple[str, str]]]:
    """The labelled table: short token sequences with one form of personal data, a look-alike, or neither."""
    rng = random.Random(seed)

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def word() -> str:
        w = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 22)))
        w = rng.choice((w, w, w, w.capitalize(), w.upper()))
        return w + rng.choice(("", "", "", "", ".", ",", "!"))

    def card() -> str:
        body = digits(15)
        return body + next(c for c in "0123456789" if luhn(body + c))

    def name() -> str:
        return word().strip(".,!").lower() or "x"

    def instance() -> tuple[str, list[str]]:
        kind = rng.choice(KINDS)
        if kind == "email":
            dot = rng.choice(("(dot)", "[dot]"))
            return kind, rng.choice((
                [f"{name()}.{digits(2)}@{name()}.example.com"], [f"{name()}@{name()}.org"],
                [name(), rng.choice(("(at)", "[at]")), name(), dot, "com"], [name(), "[at]", f"{name()}.com"],
            ))
        if kind == "ip":
            return kind, [".".join(str(rng.randint(0, 255)) for _ in range(4))]
        if kind == "card":
            c = card()
            four = [c[i : i + 4] for i in range(0, 16, 4)]
            return kind, rng.choice(([c], four, ["-".join(four)], [".".join(four)]))
        a, b, c = digits(3), digits(3), digits(4)
        return kind, rng.choice(([f"+{digits(1)}", f"({a})", f"{b}-{c}"], [f"({a})", f"{b}-{c}"], [f"{a}-{b}-{c}"], [f"+{digits(2)}", digits(3), digits(3), digits(4)]))

    def decoy() -> list[str]:
        body = digits(15)
        bad = body + next(c for c in "0123456789" if not luhn(body + c))
        return rng.choice((
            [bad], [digits(rng.randint(1, 11))], [f"{digits(1)}.{digits(1)}."], [f"{digits(1)}.{digits(1)}"], [f"{digits(4)}-{digits(2)}-{digits(2)}"],
            [f"{word()}***"], [f"{digits(2)}:{digits(2)}"], [f"{digits(2)}%"], [f"{name()}{digits(3)}"], ["".join(rng.choice("0123456789abcdef") for _ in range(40))],
            [f"@{name()}"], [f"${digits(3)}.{digits(2)}"], [f"{digits(1)},{digits(3)},{digits(3)}"], [f"({digits(1)})"], [f"{digits(4)}-{digits(4)}"], [f"v{digits(1)}.{digits(1)}.{digits(1)}"],
        ))

    out = []
    for _ in range(rows):
        row = [(word(), "O") for _ in range(rng.randint(1, 6))]
        for _ in range(rng.randint(0, 2)):
            if rng.random() < 0.6:
                kind, tokens = instance()
                tokens[-1] += rng.choice(("", "", "", ".", ","))
                row += [(t, f"{'B' if i == 0 else 'I'}-{kind}") for i, t in enumerate(tokens)]
            else:
                row += [(t, "O") for t in decoy()]
            row += [(word(), "O") for _ in range(rng.randint(1, 5))]
        out.append(row)
    return out


def tagger(seed: int = 7) -> Tagger:
    return fit_tagger(labelled_table(seed), LABELS, _own, _near, is_plain, lambda _: [], [[]])


def all_spans(texts: list[str | None], model: Tagger) -> list[tuple[list, list]]:
    """(base spans, base and added spans) of each text."""
    base = [base_spans(t) if t else [] for t in texts]
    full = [list(b) for b in base]
    some = [i for i, t in enumerate(texts) if t]
    for i, extra in zip(some, model.spans((texts[i], []) for i in some)):
        free = [x for x in extra if not any(x[1] < e and s < x[2] for _, s, e in base[i])]
        full[i] = in_order(base[i] + free, KINDS)
    return list(zip(base, full))


MADE = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_pii(documents: DataFrame, model: Tagger | None = None) -> DataFrame:
    """One row per input row: counts and digest of the base spans, and all spans."""
    model = model or tagger()

    def rows(texts: list[str | None]) -> list[tuple]:
        out = []
        for base, full in all_spans(texts, model):
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(full), len(full) - len(base)))
        return out

    return per_text(documents, rows, MADE)
