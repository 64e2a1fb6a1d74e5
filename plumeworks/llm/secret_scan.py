"""Secrets in texts: fixed patterns for three kinds, and a CRF that tags tokens as begin, inside or outside of a secret.

The patterns are the base; their spans always stay. The tagger looks at word shape, the neighbouring words and
features of the whole file, is trained from a small labelled table stated by rule (:func:`labelled_table`), and adds
``secret`` spans that overlap no base span: bearer and vendor tokens, credentials in addresses, private-key lines.

Defined results: a null or empty text has no spans; every input row gives one output row, repeated ids included; an
empty table gives an empty result; other columns are not read. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pii import in_order, joined
from .tagger import Tagger, fit_tagger, length_class, shape
from .texts import per_text

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "secret")
LABELS = ("O", "B-secret", "I-secret")

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Words that let a secret follow, as fixed values.
CUES = frozenset({"bearer", "authorization", "authorization:", "basic", "key", "key:", "secret", "token", "password", "passwd", "apikey", "api_key", "pwd", "private", "-----begin", "credential", "credentials"})
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A token can only be part of a secret if it holds a digit, or one of these.
_ODD = re.compile(r"[0-9=_]|-----|://|[a-z][A-Z]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return in_order(found, KINDS)


def _bare(token: str) -> str:
    return token.strip(".,;:!?\"'()")


def _mixture(token: str) -> str:
    return "".join(k for k, on in (("a", any(c.islower() for c in token)), ("A", any(c.isupper() for c in token)), ("0", any(c.isdigit() for c in token)), ("=", "=" in token), ("_", "_" in token), ("/", "/" in token), ("@", "@" in token)) if on)


def _changes(token: str) -> str:
    kinds = ["0" if c.isdigit() else "A" if c.isupper() else "a" for c in token[:48]]
    n = sum(x != y for x, y in zip(kinds, kinds[1:]))
    return str(min(9, 10 * n // max(1, len(kinds))))


def _own(token: str) -> list[str]:
    bare = _bare(token)
    if is_plain(token):
        return [f"plain{length_class(bare)}", "-", "-", "-", "-", "-"]
    start = next((p for p in ("ghp_", "sk_", "xox", "eyJ", "-----", "http", "AIza") if bare.startswith(p)), "-")
    return [f"{_mixture(bare)}{length_class(bare)}", _mixture(bare), f"c{_changes(bare)}{length_class(bare)}", start, bare.lower() if bare.lower() in CUES else "-", f"u{'://' in bare and '@' in bare}"]


def _near(token: str) -> list[str]:
    low = token.lower()
    return [low if low in CUES else _bare(low) if _bare(low) in CUES else "word" if is_plain(token) else "odd", "=" if token in ("=", ":") or token.endswith(":") else "-"]


def is_plain(token: str) -> bool:
    return not _ODD.search(token) and token.lower() not in CUES and _bare(token.lower()) not in CUES


def is_quiet(token: str) -> bool:
    """Plain, and ``PLAIN_FORMS`` holds a word with the same features: shorter than 24, and without a colon at its end."""
    return is_plain(token) and len(_bare(token)) < 24 and not token.endswith(":")


def file_features(text: str) -> list[str]:
    """Whether the file looks like code or settings, by the share of a few signs in it."""
    signs = sum(text.count(c) for c in "={};")
    return ["code" if signs * 40 > len(text) else "prose"]


FILES = [["code"], ["prose"]]


def labelled_table(seed: int = 11, rows: int = 450) -> list[list[tuple[str, str]]]:
    """The labelled table: prose or settings with one secret, a look-alike, or neither."""
    rng = random.Random(seed)
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def pick(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))

    def word() -> str:
        w = pick(lower, 1, 20)
        return rng.choice((w, w, w, w.capitalize(), w.upper())) + rng.choice(("", "", "", ".", ",", "***", "!!"))

    def random_key(low: int = 20, high: int = 44) -> str:
        return pick(lower + upper + digit, low, high) + rng.choice("0123456789") + pick(lower + upper + digit, 4, 8)

    def secret() -> list[tuple[str, str]]:
        one = "B-secret"
        return rng.choice((
            lambda: [("Authorization:", "O"), ("Bearer", "O"), (random_key(), one)],
            lambda: [("bearer", "O"), (random_key(), one)],
            lambda: [("ghp_" + random_key(30, 36), one)],
            lambda: [("sk_live_" + random_key(20, 30), one)],
            lambda: [(f"https://{pick(lower, 3, 8)}:{random_key(8, 12)}@{pick(lower, 4, 9)}.com/", one)],
            lambda: [("-----BEGIN", one), ("PRIVATE", "I-secret"), ("KEY-----", "I-secret"), (random_key(50, 60), "I-secret")],
            lambda: [("key", "O"), (random_key(24, 40), one)],
            lambda: [("pwd", "O"), ("=", "O"), (random_key(6, 12), one)],
            lambda: [("eyJ" + random_key(40, 60) + "." + random_key(40, 60), one)],
            lambda: [("token", "O"), ("=", "O"), (f"\"{pick(digit + 'abcdef', 40, 40)}\"", one)],
            lambda: [(f"xox{rng.choice('bpars')}-{pick(digit, 10, 13)}-{random_key(10, 20)}", one)],
            lambda: [("AIza" + pick(lower + upper + digit + "-_", 35, 35), one)],
            lambda: [(f"{pick(lower, 2, 6)}_{pick(lower, 3, 7)}_{rng.choice(('key', 'secret', 'token'))}", "O"), ("=", "O"), (pick(lower + upper + digit + "/+", 40, 40), one)],
            lambda: [(rng.choice(("secret", "key", "credential")), "O"), (pick(lower + upper + digit + "/+", 40, 40), one)],
            lambda: [(f"{pick(lower, 3, 6)}{rng.choice('-_')}{random_key(20, 36)}", one)],
        ))()

    def decoy() -> list[str]:
        return rng.choice((
            lambda: [pick(digit, 1, 16)], lambda: [f"{pick(digit, 1, 1)}.{pick(digit, 1, 1)}."], lambda: [f"{pick(lower, 3, 9)}{pick(digit, 1, 3)}"],
            lambda: [f"{pick(lower, 4, 9)}.{pick(digit, 2, 2)}@{pick(lower, 4, 8)}.example.com"], lambda: [".".join(pick(digit, 1, 3) for _ in range(4))],
            lambda: ["+1", f"({pick(digit, 3, 3)})", f"{pick(digit, 3, 3)}-{pick(digit, 4, 4)}"], lambda: [f"https://{pick(lower, 4, 9)}.com/{pick(lower, 3, 9)}"],
            lambda: ["key", word()], lambda: ["token", word()], lambda: ["the", "secret", word()], lambda: [f"{pick(lower, 3, 9)}_{pick(lower, 3, 9)}", "=", pick(digit, 1, 4)],
            lambda: [f"{pick(digit, 4, 4)}-{pick(digit, 2, 2)}-{pick(digit, 2, 2)}"], lambda: [f"{pick(lower, 2, 6)}{pick(upper, 1, 1)}{pick(lower, 2, 6)}"], lambda: [f"a={pick(digit, 1, 2)};"],
            lambda: ["/" + "/".join(pick(lower, 2, 9) for _ in range(rng.randint(2, 6)))], lambda: [f"{pick(lower, 3, 9)}{pick(upper, 1, 1)}{pick(lower, 2, 9)}{pick(upper, 1, 1)}{pick(lower, 2, 9)}"],
            lambda: ["-".join((pick(lower, 3, 9), pick(lower, 3, 9), pick(lower, 3, 9)))], lambda: [f"{pick(lower, 3, 9)}-{pick(digit, 1, 2)}.{pick(digit, 1, 2)}.{pick(digit, 1, 1)}"],
        ))()

    out = []
    for _ in range(rows):
        code = rng.random() < 0.3
        row = [(word(), "O") for _ in range(rng.randint(1, 5))]
        if code:
            row.insert(0, ("x={};y={};", "O"))
        for _ in range(rng.randint(0, 2)):
            row += secret() if rng.random() < 0.5 else [(t, "O") for t in decoy()]
            row += [(word(), "O") for _ in range(rng.randint(1, 5))]
        out.append(row)
    return out


def tagger(seed: int = 11) -> Tagger:
    return fit_tagger(labelled_table(seed), LABELS, _own, _near, is_quiet, file_features, FILES)


def all_spans(texts: list[str | None], model: Tagger) -> list[tuple[list, list]]:
    """(base spans, base and added spans) of each text."""
    base = [base_spans(t) if t else [] for t in texts]
    full = [list(b) for b in base]
    some = [i for i, t in enumerate(texts) if t]
    for i, extra in zip(some, model.spans((texts[i], file_features(texts[i])) for i in some)):
        free = [x for x in extra if not any(x[1] < e and s < x[2] for _, s, e in base[i])]
        full[i] = in_order(base[i] + free, KINDS)
    return list(zip(base, full))


MADE = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"


def find_secrets(documents: DataFrame, model: Tagger | None = None) -> DataFrame:
    """One row per input row: counts and digest of the base spans, and all spans."""
    model = model or tagger()

    def rows(texts: list[str | None]) -> list[tuple]:
        out = []
        for base, full in all_spans(texts, model):
            counts = [sum(k == kind for k, _, _ in base) for kind in BASE_KINDS]
            out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(full), len(full) - len(base)))
        return out

    return per_text(documents, rows, MADE)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or overlap of spans, replaced by a mark naming its first kind."""
    out, at, merged = [], 0, []
    for kind, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[at:s], f"<{kind}>"]
        at = e
    return "".join([*out, text[at:]])


def redact_secrets(documents: DataFrame, model: Tagger | None = None) -> DataFrame:
    """The same rows and columns with secrets replaced in ``text`` (and ``n_chars`` counted anew where it exists).

    A row stays a row, repeated ones included; a null text stays null.
    """
    model = model or tagger()

    def rows(texts: list[str | None]) -> list[tuple]:
        return [(redact(t, full) if t and full else t,) for t, (_, full) in zip(texts, all_spans(texts, model))]

    # the row travels as one column, so that no name can clash
    whole = documents.select("doc_id", "text", F.struct(*documents.columns).alias("row"))
    done = per_text(whole, rows, "redacted string", also=("row",))
    fresh = {"text": F.col("redacted"), "n_chars": F.when(F.col("redacted").isNull(), F.col("row.n_chars")).otherwise(F.length("redacted")) if "n_chars" in documents.columns else None}
    kinds = dict(documents.dtypes)
    return done.select(*[fresh[c].cast(kinds[c]).alias(c) if c in fresh else F.col("row").getField(c).alias(c) for c in documents.columns])
