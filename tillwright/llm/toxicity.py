"""Toxicity by compression distance.

Two zstandard dictionaries are made from a bounded sample of labelled texts:
ordinary prose, and the same prose followed by the vocabulary that sets toxic
texts apart. A window that holds such vocabulary compresses better with the
second dictionary; the difference in length, in bytes, is the window's margin.
How far margins must go before a text counts as toxic is calibrated on labelled
rows that the dictionaries haven't seen, by a logistic curve over three
summaries of a text's margins. Sampled texts of any length are used as a whole: Spark
counts their words and summarises them, and only words, windows and summaries reach
the driver.
"""

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.shared import id_and_text, small_batches, staged

#: Labelled rows of each class that the dictionaries may be made from, and rows of both
#: classes for the calibration.
DICTIONARY_ROWS = 1500
CALIBRATION_ROWS = 3000
#: Bytes of ordinary prose in both dictionaries, and at most of toxic vocabulary.
PROSE_BYTES = 96 << 10
VOCABULARY_BYTES = 2 << 10
#: A word of the vocabulary occurs in this share of the toxic texts at least, and
#: e to this power times as often there as in ordinary texts.
WORD_SHARE = 0.02
WORD_LOG_ODDS = 2.0
WINDOW_WORDS = 24
LEVEL = 9
#: A score from here on is a prediction of toxicity.
THRESHOLD = 0.3
#: Rows whose crc32(doc_id) leaves this remainder by 4 are never learnt from, and
#: rows with this one calibrate.
HELD_OUT, CALIBRATING = 2, 1


def fold(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def windows(text: str, size: int = WINDOW_WORDS) -> list[bytes]:
    words = text.lower().split()
    return [" ".join(words[i : i + size]).encode() for i in range(0, len(words), size)]


class Distance:
    """Margins and scores from two dictionaries and the curve's weights."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights=None):
        self.ordinary, self.toxic, self.weights = ordinary, toxic, weights
        self._lengths = [self._compressor(ordinary), self._compressor(toxic)]

    def __reduce__(self):
        return Distance, (self.ordinary, self.toxic, self.weights)

    @staticmethod
    def _compressor(data: bytes):
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False, level=LEVEL
        ).compress

    def summary(self, text: str) -> tuple[float, float, float]:
        ordinary, toxic = self._lengths
        margins = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)] or [0], float)
        return margins.sum() / np.sqrt(len(margins)), margins.mean(), margins.max()

    def score(self, text: str) -> float:
        if self.weights is None:
            return 0.0
        z = self.weights[0] + np.dot(self.weights[1:], self.summary(text))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def vocabulary(texts: DataFrame) -> bytes:
    """The words that set toxic texts apart, from rows (text, toxic); copies count once."""
    apart = texts.select("toxic", "text").distinct()
    counts = apart.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("ordinary")).first()
    words = apart.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("word"))
    held = words.filter("word <> ''").groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("n"), F.count_if(F.col("toxic") == 0).alias("m")
    )
    odds = F.log((F.col("n") + 0.5) / (counts.toxic + 1)) - F.log((F.col("m") + 0.5) / (counts.ordinary + 1))
    least = max(3, WORD_SHARE * counts.toxic)
    chosen = held.filter(F.col("n") >= least).withColumn("odds", odds).filter(F.col("odds") > WORD_LOG_ODDS)
    # A word and its space take two bytes of VOCABULARY_BYTES at least.
    rows = chosen.orderBy(F.desc(F.col("odds") * F.col("n")), "word").limit(VOCABULARY_BYTES // 2).collect()
    return (" " + " ".join(r.word for r in rows) + " ").encode()[:VOCABULARY_BYTES]


def prose(texts: DataFrame, words: int = 6) -> bytes:
    """Windows of ordinary texts, from rows (text, toxic), in the order of a hash."""
    split = texts.filter("toxic = 0").select("text").distinct().select(F.split(F.lower("text"), r"\s+").alias("words"))
    starts = F.sequence(F.lit(1), F.size("words"), F.lit(words))
    pieces = split.select(F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, words), " "))).alias("piece"))
    # Of a piece without a space, which may be long, the last dictionary bytes are enough.
    pieces = pieces.select(F.substring("piece", 1, 1024).alias("piece")).filter(F.length("piece") >= 2 * words)
    rows = pieces.orderBy(F.xxhash64("piece"), "piece").limit(PROSE_BYTES // (2 * words)).collect()
    return " ".join(r.piece for r in rows).encode()[:PROSE_BYTES]


def dictionaries(texts: DataFrame, seed: int = 1) -> Distance:
    """The two dictionaries from rows (text, toxic)."""
    ordinary, toxic = prose(texts), vocabulary(texts)
    rnd = random.Random(seed)
    # The ordinary dictionary is as long, with bytes that match no text in its place.
    blank = bytes(rnd.randrange(0xF8, 0x100) for _ in toxic)
    return Distance(ordinary + blank, ordinary + toxic)


def calibrated(distance: Distance, summaries, toxic: list[int], ridge: float = 1e-2) -> Distance:
    """``distance`` with weights fitted by Newton's method to summaries of labelled texts."""
    x = np.array(summaries, float)
    y = np.array(toxic, float)
    middle, spread = x.mean(0), x.std(0) + 1e-9
    design = np.c_[np.ones(len(x)), (x - middle) / spread]
    w = np.zeros(design.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + penalty @ w
        step = np.linalg.solve((design.T * (p * (1 - p) + 1e-9)) @ design + penalty + 1e-9 * np.eye(len(w)), slope)
        w = w - np.clip(step, -3, 3)
    own = w[1:] / spread
    return Distance(distance.ordinary, distance.toxic, np.r_[w[0] - own @ middle, own])


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, doc_id, toxic, text) of a bounded number of labelled rows: of each part, the
    first in the order of a hash of their ids. Of several texts of an id one is taken."""
    order = F.xxhash64("doc_id", F.lit("sample"))
    learning = ~fold().isin(HELD_OUT, CALIBRATING)
    wanted = {
        "toxic": (learning & (F.col("toxic") == 1), DICTIONARY_ROWS),
        "ordinary": (learning & (F.col("toxic") == 0), DICTIONARY_ROWS),
        "calibration": (fold() == CALIBRATING, CALIBRATION_ROWS),
    }
    held, chosen = docs.select("doc_id"), None
    for part, (condition, n) in wanted.items():
        # Twice as many ids as wanted, since some may have no text: a fixed bound for the broadcast.
        asked = labels.filter(condition).orderBy(order, "doc_id").limit(2 * n)
        found = held.join(F.broadcast(asked), "doc_id").distinct().orderBy(order, "doc_id").limit(n)
        found = found.select("doc_id", "toxic", F.lit(part).alias("part"))
        chosen = found if chosen is None else chosen.unionByName(found)
    chosen = staged(chosen, "sampled-ids")
    texts = docs.join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")
    return staged(texts.groupBy("part", "doc_id", "toxic").agg(one).select("part", "doc_id", "toxic", "one.text"), "sample")


def _summaries(texts: DataFrame, distance: Distance) -> list:
    """(toxic, summary) of each row, in the order of ids."""

    @F.pandas_udf("array<double>")
    def summary(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series([list(map(float, distance.summary(t))) for t in some])

    small_batches(texts.sparkSession)
    return texts.select("doc_id", "toxic", summary("text").alias("of")).orderBy("doc_id").collect()


def train(docs: DataFrame, labels: DataFrame) -> Distance:
    """Dictionaries and thresholds from ``labels`` (doc_id, toxic) and their texts.

    Rows without an id or label aren't used; several labels of an id count as toxic
    if one is. Without rows of both classes every text scores 0.
    """
    docs = id_and_text(docs)
    labels = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sample = _sample(docs, labels)
    kinds = {(r.part, r.toxic) for r in sample.select("part", "toxic").distinct().collect()}
    if not {("toxic", 1), ("ordinary", 0), ("calibration", 0), ("calibration", 1)} <= kinds:
        return Distance(b"\xf8" * 8, b"\xf8" * 8)
    distance = dictionaries(sample.filter("part <> 'calibration'"))
    rows = _summaries(sample.filter("part = 'calibration'"), distance)
    return calibrated(distance, [r.of for r in rows], [r.toxic for r in rows])


def with_scores(docs: DataFrame, distance: Distance, name: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score of each whole text, without a
    shuffle. A null text is an empty one; empty texts get the curve's value at 0."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([distance.score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, score(F.coalesce(docs["text"], F.lit(""))))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs`` (doc_id, text).

    Only texts are scored; labels of rows in the held-out fold are never seen. A
    null id is held out of nothing. Repeated rows get the same score each, an empty
    table gives no rows, and other columns aren't read.
    """
    scored = with_scores(id_and_text(docs), train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with their columns."""
    columns, score = docs.columns, "_toxicity"
    while score in columns:
        score += "_"
    scored = with_scores(docs, train(docs, labels), score)
    return scored.filter(F.col(score) < THRESHOLD).select(*[scored[c] for c in columns])
