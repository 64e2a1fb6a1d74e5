"""Tagging of white-space tokens with a CRF, shared by the personal-data and the secret scan.

Only tokens that are not *plain* words, and some tokens around them, are decoded. This changes nothing: a plain word
among plain words has one of a few feature sets, :func:`margins` takes the least by which "outside" wins in any of
them, and ``Crf.reach`` proves from those margins how many such words make a window exact. Without a proof, whole
texts are decoded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np

from .crf import Crf, decode_scores, feature_rows, train

TOKEN = re.compile(r"\S+")
EDGES = ".,;:!?\"'()[]{}<>|"
NEIGHBOURS = (-2, -1, 1)
Features = Callable[[str], list[str]]

#: Stand-ins for every kind of plain word: the features only see case and a length class. Tokens with features that no
#: form has must not count as plain.
PLAIN_FORMS = ["a", "abcd", "abcdefgh", "abcdefghijkl", "abcdefghijklmnopqrst", "A", "Abcd", "Abcdefgh", "Abcdefghijkl", "Abcdefghijklmnopqrst", "ABCD", "ABCDEFGH", "ABCDEFGHIJKL", "ABCDEFGHIJKLMNOPQRST"]


def shape(token: str) -> str:
    """Letters become A or a, digits 0, the rest stays; repeats are folded; at most 12 characters."""
    if token.isalpha() and token.islower():
        return "a"
    out = []
    for c in token[:64]:
        s = "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != s:
            out.append(s)
        if len(out) == 12:
            break
    return "".join(out)


def length_class(token: str) -> str:
    n = len(token)
    return "1" if n < 2 else "2" if n < 6 else "6" if n < 12 else "12" if n < 16 else "16" if n < 24 else "24"


def rows_for(tokens: list[str], own: Features, near: Features, page: list[str], low: int = 0, high: int | None = None) -> np.ndarray:
    """Feature rows of tokens low to high: their own, those of their neighbours, and those of the document."""
    high = len(tokens) if high is None else high
    seen = {i: near(tokens[i]) for i in range(max(0, low - 2), min(len(tokens), high + 1))}
    blank = ["^"] * len(near("a"))
    out = []
    for i in range(low, high):
        names = [f"w{k}={v}" for k, v in enumerate(own(tokens[i]))]
        for d in NEIGHBOURS:
            names += [f"{d}.{k}={v}" for k, v in enumerate(seen.get(i + d, blank))]
        out.append(feature_rows(names + page))
    return np.array(out, dtype=np.int32)


class TokenScores:
    """What a token adds to the label scores: at its own place, and at the places it neighbours.

    Scores are sums over features, so these parts are worked out once for each distinct set of features, of which there are few, and
    added up by place. Sets of features are looked up by token; at most ``room`` tokens and sets are kept.
    """

    def __init__(self, crf: Crf, own: Features, near: Features, room: int = 40_000):
        self.crf, self.own, self.near, self.room = crf, own, near, room
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.sets: dict[tuple, int] = {}
        self.table = np.zeros((1 << 8, 1 + len(NEIGHBOURS), len(self.crf.labels)))
        self._row((tuple(self.own("a")), ("^",) * len(self.near("a"))))  # row 0: beyond the ends of a text

    def _row(self, features: tuple[tuple[str, ...], tuple[str, ...]]) -> int:
        at = self.sets.get(features)
        if at is None:
            at = self.sets[features] = len(self.sets)
            if at >= len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            own, near = features
            groups = [[f"w{k}={v}" for k, v in enumerate(own)], *[[f"{d}.{k}={v}" for k, v in enumerate(near)] for d in NEIGHBOURS]]
            for part, names in enumerate(groups):
                self.table[at, part] = self.crf.weights[feature_rows(names)].sum(0)
        return at

    def _add(self, token: str) -> int:
        at = self.ids[token] = self._row((tuple(self.own(token)), tuple(self.near(token))))
        return at

    def scores(self, tokens: list[str], page: list[str], low: int, high: int) -> np.ndarray:
        """Label scores of the tokens low to high."""
        if len(self.sets) > self.room:
            self._clear()
        elif len(self.ids) > self.room:
            self.ids = {}
        first = max(0, low - 2)
        at = np.zeros(high - low + 3, dtype=np.int64)  # places low - 2 to high; 0 stands for what lies beyond an end
        for i in range(first, min(len(tokens), high + 1)):
            token = tokens[i]
            known = self.ids.get(token)
            at[i - low + 2] = self._add(token) if known is None else known
        size = high - low
        out = self.table[at[2 : 2 + size], 0]
        for part, d in enumerate(NEIGHBOURS, start=1):
            out = out + self.table[at[2 + d : 2 + d + size], part]
        return out + self.crf.weights[feature_rows(page)].sum(0) if page else out


class Tagger:
    """A trained model with its features and the rule for plain words."""

    def __init__(self, crf: Crf, own: Features, near: Features, is_plain: Callable[[str], bool], pages: list[list[str]]):
        self.crf, self.own, self.near, self.is_plain = crf, own, near, is_plain
        self.reach = crf.reach(margins(crf, own, near, pages), crf.labels.index("O"))
        self.parts = TokenScores(crf, own, near)

    def windows(self, tokens: list[str]) -> list[tuple[int, int]]:
        """Ranges of tokens to decode: unusual ones with enough plain words on both sides."""
        if self.reach is None:
            return [(0, len(tokens))] if tokens else []
        wide = 2 + 2 * self.reach
        runs: list[list[int]] = []
        unusual = {t for t in set(tokens) if not self.is_plain(t)}
        if not unusual:
            return []
        for i, token in enumerate(tokens):
            if token not in unusual:
                continue
            low, high = max(0, i - wide), min(len(tokens), i + wide + 1)
            if runs and low <= runs[-1][1]:
                runs[-1][1] = high
            else:
                runs.append([low, high])
        return [(a, b) for a, b in runs]

    def spans(self, texts: Iterable[tuple[str, list[str]]]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of each (text, document features), trimmed of punctuation at the edges."""
        texts = list(texts)
        jobs, sequences = [], []
        for d, (text, page) in enumerate(texts):
            tokens = text.split()
            windows = self.windows(tokens)
            at = [m.span() for m in TOKEN.finditer(text)] if windows else []
            for low, high in windows:
                jobs.append((d, at[low:high]))
                sequences.append(self.parts.scores(tokens, page, low, high))
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        for (d, run), path in zip(jobs, decode_scores(self.crf, sequences)):
            out[d] += _join(texts[d][0], run, [self.crf.labels[k] for k in path])
        return out


def _join(text: str, run: list[tuple[int, int]], labels: list[str]) -> list[tuple[str, int, int]]:
    found: list[list] = []
    last = "O"
    for (s, e), label in zip(run, labels):
        kind = label[2:]
        if label == "O":
            pass
        elif label[0] == "I" and last[2:] == kind and found:
            found[-1][2] = e
        else:
            found.append([kind, s, e])
        last = label
    out = []
    for kind, s, e in found:
        while s < e and text[e - 1] in EDGES:
            e -= 1
        while s < e and text[s] in EDGES and not (text[s] == "(" and ")" in text[s:e]):
            s += 1
        if s < e:
            out.append((kind, s, e))
    return out


def margins(crf: Crf, own: Features, near: Features, pages: list[list[str]]) -> np.ndarray:
    """For each label, the least by which outside beats it at a plain word among plain words: the worst of each part, added up."""
    outside = crf.labels.index("O")

    def worst(groups: list[list[str]]) -> np.ndarray:
        scores = np.array([crf.weights[feature_rows(g)].sum(0) if g else np.zeros(len(crf.labels)) for g in groups])
        return (scores[:, [outside]] - scores).min(0)

    blank = ["^"] * len(near("a"))
    least = worst([[f"w{k}={v}" for k, v in enumerate(own(form))] for form in PLAIN_FORMS]) + worst(pages)
    for d in NEIGHBOURS:
        least = least + worst([[f"{d}.{k}={v}" for k, v in enumerate(seen)] for seen in [blank, *map(near, PLAIN_FORMS)]])
    return least


def fit_tagger(examples: list[list[tuple[str, str]]], labels: tuple[str, ...], own: Features, near: Features, is_plain: Callable[[str], bool], page_of: Callable[[str], list[str]], pages: list[list[str]]) -> Tagger:
    """Train from a labelled table: each example is a list of (token, label)."""
    index = {label: k for k, label in enumerate(labels)}
    sequences = [rows_for([t for t, _ in ex], own, near, page_of(" ".join(t for t, _ in ex))) for ex in examples]
    targets = [np.array([index[label] for _, label in ex]) for ex in examples]
    return Tagger(train(sequences, targets, labels), own, near, is_plain, pages)
