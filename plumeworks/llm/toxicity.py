"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

The features of a text are densities (a lexicon learned from the labelled sample, a short fixed list, list words near a
second person, capitals, punctuation, obfuscated spellings) and a few lengths; label, language, source and id are never
among them. The lexicon holds words and word beginnings by their log-odds in the labelled sample.

Training reads at most about ``bound`` labelled rows (a hash of the id decides, at a rate taken from the counted rows);
rows whose ``crc32(id) mod 5`` is 0 are never read for it. Lexicon and trees use three quarters of them, the calibration
the rest. Everything else covers all rows.

Defined results: null and empty texts are scored like a text without words; each input row gives one output row,
repeated ids included; a null id counts as held out; several labels for one id count as toxic if one of them is; with no
labels, or labels of one kind only, every score is the share of toxic labels (0 without labels); an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import materialise
from .texts import per_text

#: Words of abuse, words of the second person, and the usual stand-ins for letters.
ABUSE = frozenset("idiot moron stupid loser trash scum clown pathetic worthless disgusting dumb fool garbage vermin shut hate kill".split())
SECOND_PERSON = frozenset("you your you're youre yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie usted ustedes tú ti tus".split())
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})

PUNCTUATION = ".,;:!?\"'()[]{}<>*#$|-_=+/\\"
BEGINNINGS = range(4, 10)

FEATURES = (
    "strong", "weak", "odds", "beginnings", "abuse", "hidden_abuse", "near_you", "you", "capital_words", "capital_letters", "punctuation", "exclaims",
    "questions", "odd_spelling", "digits", "log_words", "word_length", "hits_log", "best",
)


def grams(token: str) -> list[str]:
    """The word itself and its beginnings."""
    word = token.strip(PUNCTUATION).lower()
    return [f"={word}", *(word[:k] for k in BEGINNINGS if len(word) > k)] if word else []


def learn_lexicon(sample: DataFrame, share: float = 0.01, most: int = 3000) -> dict[str, float]:
    """Words and beginnings that mark toxic rows of ``sample`` (text, toxic), with their log-odds.

    Counts cover the whole sample; what fewer than three toxic rows, or fewer than ``share`` of them, hold is not counted
    in the others. ``most`` is the size of the model: the strongest are kept.
    """
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = max(3, int(share * sizes.get(1, 0)))

    def count(only: frozenset[str] | None, rows: DataFrame) -> dict[str, int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    held = {g for t in set((text or "").split()) for g in grams(t)}
                    seen.update(held if only is None else held & only)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["gram", "n"])

        counted = rows.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        return {r["gram"]: r["n"] for r in counted.where(F.col("n") >= (least if only is None else 1)).collect()}

    # bounded by the sample's toxic words
    bad = count(None, sample.where("toxic = 1"))
    good = count(frozenset(bad), sample.where("toxic = 0")) if bad else {}
    one, none = sizes.get(1, 0) + 1.0, sizes.get(0, 0) + 1.0
    odds = {g: math.log((n + 0.5) / one) - math.log((good.get(g, 0) + 0.5) / none) for g, n in bad.items()}
    strong = sorted((g for g in odds if odds[g] > 1), key=lambda g: (-odds[g] * math.log1p(bad[g]), g))
    return {g: odds[g] for g in strong[:most]}


#: The numbers of a word in lower case that nothing is known about, and of one in the second person.
PLAIN = (0.0,) * 14
YOU = (*PLAIN[:6], 1.0, *PLAIN[7:])


@dataclass
class Reader:
    """Turns texts into feature rows. What depends on a token alone is worked out once per distinct token.

    Most tokens share one of a few rows of numbers, so the table holds distinct rows and a token only points to one. Tokens are
    kept in two generations of ``room`` each: a full one becomes the old one, and tokens met again move on from there.
    """

    lexicon: dict[str, float]
    room: int = 60_000

    def __post_init__(self) -> None:
        # a beginning of the lexicon can only match a word that shares its first letters
        self.starts = {g[: BEGINNINGS[0]] for g in self.lexicon if not g.startswith("=")}
        self.ids: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.rows: dict[tuple[float, ...], int] = {}
        self.table = np.zeros((1 << 8, 14))

    def _row_of(self, token: str) -> int:
        """The place of a token's numbers in the table."""
        at = self.old.get(token)
        if at is None:
            row = self._token(token)
            at = self.rows.get(row)
            if at is None:
                at = self.rows[row] = len(self.rows)
                if at >= len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[at] = row
        self.ids[token] = at
        return at

    def _next_generation(self) -> None:
        self.old, self.ids = self.ids, {}
        if len(self.rows) > self.room:
            self.old, self.rows, self.table = {}, {}, np.zeros((1 << 8, 14))

    def _token(self, token: str) -> tuple[float, ...]:
        word = token.strip(PUNCTUATION).lower()
        whole = best = self.lexicon.get(f"={word}", 0.0) if word else 0.0
        odds = [whole]
        if len(word) > BEGINNINGS[0]:
            odds = [whole, *(self.lexicon.get(word[:k], 0.0) for k in BEGINNINGS if len(word) > k)] if word[: BEGINNINGS[0]] in self.starts else [whole, 0.0]
            best = max(odds)
        abuse = word in ABUSE
        if best == whole == 0.0 and not abuse and token.isalpha() and token.islower():
            return YOU if word in SECOND_PERSON else PLAIN
        common = (float(best > 2.5), float(1.0 < best <= 2.5), best, float(max(odds[1:], default=0.0) > max(2.0, whole)), float(abuse))
        capitals = 0 if token.islower() else sum(map(str.isupper, token))
        if token.isalpha():
            return (*common, 0.0, float(word in SECOND_PERSON), float(len(token) > 1 and token.isupper()), float(capitals), 0.0, 0.0, 0.0, 0.0, 0.0)
        letters, digits = sum(map(str.isalpha, token)), sum(map(str.isdigit, token))
        hidden = not abuse and token.lower().translate(STAND_INS).strip(PUNCTUATION) in ABUSE
        return (
            *common, float(hidden), float(word in SECOND_PERSON), float(letters > 1 and token.isupper()), float(capitals),
            float(len(token) - sum(map(str.isalnum, token))), float(token.count("!")), float(token.count("?")),
            float(letters > 0 and not token.strip(PUNCTUATION).isalpha()), float(digits),
        )

    def features(self, text: str | None) -> list[float]:
        tokens = (text or "").split()
        n = len(tokens)
        if not n:
            return [0.0] * len(FEATURES)
        if len(self.ids) > self.room:
            self._next_generation()
        known = self.ids.get
        places = [known(t, -1) for t in tokens]
        if -1 in places:
            places = [self.ids[t] if t in self.ids else self._row_of(t) for t in tokens]
        own = self.table[places]
        sums = own.sum(0)
        hit = own[:, 0] + own[:, 4] + own[:, 5] > 0
        near = 0
        if sums[6] and hit.any():
            reach = np.convolve(own[:, 6] > 0, np.ones(7, dtype=int), "same")[:n] if n >= 7 else np.full(n, sums[6])
            near = int((hit & (reach > 0)).sum())
        letters = sum(map(len, tokens))
        per = sums / n
        return [
            per[0], per[1], per[2], per[3], per[4], per[5], near / n, per[6], per[7], sums[8] / letters, sums[9] / letters, sums[10] / letters, sums[11] / letters,
            per[12], sums[13] / letters, math.log1p(n), letters / n, math.log1p(sums[0]), float(own[:, 2].max()),
        ]


def with_features(documents: DataFrame, lexicon: dict[str, float], also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``also`` and one double column per feature."""
    reader = Reader(lexicon)

    def rows(texts: list[str | None]) -> list[tuple]:
        return [tuple(reader.features(t)) for t in texts]

    return per_text(documents, rows, ", ".join(f"{f} double" for f in FEATURES), also=also)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(documents: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """doc_id, text, toxic, part (0 to 3) of about ``bound`` labelled training rows at most."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    total = marked.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    kept = marked.where(place < int((1 << 30) * min(1.0, bound / max(1, total)))).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(kept), "doc_id")  # about ``bound`` rows of three numbers


def scored(documents: DataFrame, labels: DataFrame, also: tuple[str, ...] = (), bound: int = 20_000, trees: int = 25, depth: int = 4) -> DataFrame:
    """doc_id, ``also``, score for every row of ``documents``; ``also`` may not have the name of a feature."""
    sample = materialise(labelled_sample(documents, labels, bound), "toxicity-sample")
    fitting = sample.where("part > 0")
    counts = {(r["fit"], r["toxic"]): r["n"] for r in sample.groupBy((F.col("part") > 0).alias("fit"), "toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = counts.get((True, 1), 0), counts.get((True, 0), 0)
    if not bad or not good:
        share = bad / (bad + good) if bad + good else 0.0
        return documents.select(F.col("doc_id").cast("long").alias("doc_id"), *also, F.lit(share).alias("score"))
    # a row of the sample must not meet odds counted from itself, so either half is read with the other half's lexicon
    sides = [fitting.where(f"pmod(xxhash64(doc_id, part), 2) = {k}") for k in (0, 1)]
    crossed = [with_features(side, learn_lexicon(other), ("toxic",)) for side, other in zip(sides, reversed(sides))]
    lexicon = learn_lexicon(fitting)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    # a bounded sample that boosting passes over a hundred times: a few partitions
    rows = materialise(crossed[0].unionByName(crossed[1]), "toxicity-train").coalesce(4)
    model = GBTClassifier(labelCol="toxic", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=17, minInstancesPerNode=5).fit(assembler.transform(rows))

    def raw(df: DataFrame) -> DataFrame:
        return model.transform(assembler.transform(df)).withColumn("raw", vector_to_array("probability")[1])

    held = raw(with_features(sample.where("part = 0"), lexicon, ("toxic",))).select(F.col("toxic").cast("double").alias("label"), "raw")
    out = raw(with_features(documents, lexicon, also))
    if counts.get((False, 1), 0) and counts.get((False, 0), 0):
        isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="level").fit(materialise(held, "toxicity-held"))
        out = isotonic.transform(out)
    else:
        out = out.withColumn("level", F.col("raw"))
    # a trace of the raw value keeps the order inside the steps of the calibration
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("level") * 0.999 + F.col("raw") * 0.001))
    return out.select("doc_id", *also, value.alias("score"))


def score(documents: DataFrame, labels: DataFrame, bound: int = 20_000, trees: int = 25, depth: int = 4) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``."""
    rows = scored(documents, labels, (), bound, trees, depth)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame, bound: int = 20_000) -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, with the same columns. What is not the text travels as one column."""
    apart = documents.schema["text"].dataType == StringType()  # another kind is scored as a string and kept as it is
    row = F.struct(*[c for c in documents.columns if not (apart and c == "text")]).alias("row")
    rows = scored(documents.select("doc_id", "text", row), labels, ("row", "text") if apart else ("row",), bound).where("score < 0.5")
    return rows.select("row.*", "text").select(*documents.columns) if apart else rows.select("row.*")
