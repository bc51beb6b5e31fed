"""Toxicity scores: boosted trees over dense features of whole texts, isotonic calibration.

Features are densities of lexicon words, their nearness to the second person, capitals,
punctuation and obfuscated spellings. The lexicon is a short fixed list joined with words
that the labelled sample shows in many different toxic documents and hardly elsewhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.batches import per_slice
from lastmile.llm.boosting import BoostedTrees, Isotonic
from lastmile.llm.sample import labelled
from lastmile.llm.shield import restored, shielded
from lastmile.operators.sizing import written

MOST_LABELLED = 20_000  # bound of the labelled sample that the model is fitted on
MOST_LEARNT = 200
THRESHOLD = 0.3

# Insulting words.
LEXICON = frozenset(
    "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass fool fools foolish imbecile"
    " cretin clown clowns loser losers scum trash garbage filth filthy vermin worthless pathetic disgusting"
    " useless hate hateful ugly jerk creep freak bastard bitch crap damn shit shitty fuck fucking fucker"
    " asshole dick whore slut retard retarded kill die hell"
    " dumm dummkopf blöd trottel abschaum versager arschloch scheiße"
    " stupide imbécile crétin débile connard merde ordure minable"
    " estúpido estúpida imbécil tonto idiota basura mierda asqueroso inútil".split()
)
SECOND_PERSON = frozenset(
    "you your you're youre yourself u ur du dich dir dein deine ihr euch tu toi ton ta te vous votre tú usted tus".split()
)
NEAR = 5
STRIP = ".,;:!?\"'()[]{}<>#*$%&|-_~`/\\…«»“”„’"
LEET = str.maketrans("013457@$!|", "oleastasii")
INNER = re.compile(r"[^\w]|_")
RUN = re.compile(r"(.)\1{2,}")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
SHOUT = re.compile(r"[!?]{2,}")
FEATURES = (
    "log_words", "listed_density", "listed_count", "learnt_density", "learnt_count", "hidden_density", "hidden_count",
    "near_second_person", "second_person_density", "capital_share", "capital_words", "exclamations",
    "punctuation_runs", "symbol_share", "densest_window", "distinct_hits",
)


def plain(word: str) -> str:
    """An obfuscated spelling undone: look-alike digits and signs, inner signs, long runs."""
    return INNER.sub("", RUN.sub(r"\1", word.translate(LEET)))


def features(text: str | None, learnt: frozenset[str]) -> list[float]:
    text = text or ""
    lowered = text.lower()
    words = [w.strip(STRIP) for w in lowered.split()]
    count = len(words)
    if not count:
        return [0.0] * len(FEATURES)
    listed = [i for i, w in enumerate(words) if w in LEXICON]
    known = [i for i, w in enumerate(words) if w in learnt] if learnt else []
    hidden = []
    for i, w in enumerate(words):
        if w and not w.isalpha() and len(w) < 40 or RUN.search(w):
            bare = plain(w)
            if bare != w and (bare in LEXICON or bare in learnt):
                hidden.append(i)
    spaced = [INNER.sub("", m) for m in SPACED.findall(lowered)]
    hidden_count = len(hidden) + sum(s in LEXICON or s in learnt for s in spaced)
    hits = sorted({*listed, *known, *hidden})
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and second:
        at = np.searchsorted(second, hits)
        s = np.array([-10_000, *second, 10**12])
        near = int((np.minimum(np.array(hits) - s[at], s[at + 1] - np.array(hits)) <= NEAR).sum())
    densest = 0
    for k, i in enumerate(hits):  # most hits within a hundred words
        while hits[k - densest] < i - 99:
            densest -= 1
        densest += 1
    letters = sum(map(str.isalpha, text)) if count < 50 else len(text)
    capitals = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text))
    marks = sum(map(text.count, "#*$%&|@"))
    return [
        float(np.log1p(count)), len(listed) / count, float(len(listed)), len(known) / count, float(len(known)),
        hidden_count / count, float(hidden_count), near / count, len(second) / count, capitals / max(letters, 1),
        len(re.findall(r"\b[A-ZÀ-ÖØ-Þ]{2,}\b", text)) / count, text.count("!") / count,
        len(SHOUT.findall(text)) / count, marks / len(text), float(densest),
        float(len({words[i] for i in hits})),
    ]


@dataclass
class ToxicityModel:
    learnt: frozenset[str]
    trees: BoostedTrees
    calibration: Isotonic

    def scores(self, texts) -> np.ndarray:
        rows = np.array([features(t, self.learnt) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return np.clip(self.calibration(self.trees.probability(rows)), 0.0, 1.0)


def learnt_words(sample: DataFrame, most: int = MOST_LEARNT) -> frozenset[str]:
    """Words of many unlike toxic documents of the sample (_id, y, text) and of hardly any others.

    Near copies count once: documents are told apart by the smallest hash of their words.
    At most ``most`` words come to the driver.
    """
    words = (
        sample.withColumn("_w", F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")))
        .withColumn("_kind", F.array_min(F.transform("_w", lambda w: F.xxhash64(w))))
        .select("y", "_kind", F.explode("_w").alias("word"))
        .where("length(word) BETWEEN 3 AND 30")
        .groupBy("word", "y").agg(F.count_distinct("_kind").alias("n"))
        .groupBy("word").agg(
            F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("good"),
        )
    )
    sizes = sample.agg(F.sum("y"), F.count(F.lit(1))).first()
    bad, good = (sizes[0] or 0) + 1, sizes[1] - (sizes[0] or 0) + 1
    lift = (F.col("bad") / bad) / ((F.col("good") + 1) / good)
    found = (
        words.where((F.col("bad") >= max(4, bad // 200)) & (lift > 8)).orderBy(lift.desc(), "word").limit(most)
    )
    return frozenset(r.word for r in found.select("word").collect())


def fit(
    docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, id_column: str = "doc_id",
    text: str = "text",
) -> ToxicityModel:
    """Fit on at most ``most_labelled`` labelled documents; only feature rows reach the driver.

    Trees are fitted on four fifths and calibrated on the last fifth. Without labels of
    both classes the model gives every text the share of toxic labels (0 without labels).
    """
    sample = written(labelled(docs, labels, "toxic", most_labelled, id_column, text))
    learnt = learnt_words(sample)

    rows = per_slice("text", "array<double>", lambda: lambda texts: [features(t, learnt) for t in texts])
    table = (
        sample.select("_id", "y", rows.alias("x")).groupBy("_id").agg(F.max("y").alias("y"), F.min("x").alias("x"))
        .select("y", F.pmod(F.xxhash64("_id"), F.lit(5)).alias("fold"), "x").toArrow()
    )
    y = table.column("y").to_numpy().astype(float)
    x = np.array(table.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    last = table.column("fold").to_numpy() == 0
    if len(y) < 50 or y.min() == y.max() or y[last].sum() < 5 or y[~last].sum() < 5:
        last = np.zeros(len(y), bool)
    trees = BoostedTrees().fit(x[~last], y[~last])
    held = last if last.any() else ~last
    return ToxicityModel(learnt, trees, Isotonic.fit(trees.probability(x[held]), y[held]))


def score(model: ToxicityModel, text: str = "text") -> Column:
    """Probability that the text is toxic; null and empty texts are scored as empty."""

    return per_slice(text, "double", lambda: lambda texts: model.scores(texts).tolist())


def scored(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most_labelled: int = MOST_LABELLED,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with ``score`` and ``predicted``; columns of these names are replaced."""
    model = fit(docs, labels, most_labelled, id_column, text)
    own = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*own, score(model, text).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def without_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """The documents whose score stays below the threshold, with their columns."""
    model = fit(docs, labels, most_labelled)
    inner = shielded(docs, ("text",))
    return restored(inner.withColumn("_toxic", score(model)).where(F.col("_toxic") < threshold), inner, docs)
