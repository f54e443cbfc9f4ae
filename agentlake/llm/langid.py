"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities for the pieces of a fixed public vocabulary. A word's probability in a language is the sum
over all its segmentations into pieces, computed by the forward algorithm; a text's is the product over its words; the
language with the largest one is predicted, and its posterior under equal priors is the score. The piece probabilities are
fitted by expectation maximisation over the same segmentations, on a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from agentlake.core import fits, stable
from agentlake.llm.rows import held, small_batches, texts
from agentlake.operators.scans import first_k

#: Labelled documents per language that are learned from, at most; the ones with the smallest hashes of their ids.
SAMPLE_DOCS = 120

#: Rounds of expectation maximisation; pieces' worth of the common distribution mixed into each language's.
ROUNDS, SMOOTHING = 2, 500.0

#: Probability of a letter that is no piece; alike in all languages, so it tells nothing.
UNKNOWN = 1e-8

#: Words whose probabilities a worker remembers, and their letters in all.
REMEMBERED, LETTERS = 300_000, 4_000_000
#: Letters of a run that are learned from at once; a longer run is learned from in consecutive parts.
PART = 200
#: Prefixes shorter than this keep their sums; so many of them at most.
KNOWN, PREFIXES = 7, 100_000

UNDETERMINED = "und"
_WORDS = re.compile(r"[^\W\d_]+")
_TINY, _BOOST = 1e-120, 1e100


def pieces(path: str) -> list[str]:
    """Lower-case letter pieces of a vocabulary file, the mark of a word's start included."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return [p for p in every if (x := p.replace("▁", "", 1)) == "" and p == "▁" or x.isalpha() and x == x.lower()]


def words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORDS.findall(text.lower())


class Model:
    """``table``: piece -> its probability in each of ``languages``."""

    def __init__(self, languages: list[str], vocabulary: list[str], probabilities: np.ndarray):
        self.languages = languages
        self.table = dict(zip(vocabulary, map(tuple, probabilities.tolist())))
        self.longest = max(map(len, vocabulary), default=1)
        #: Every end of a piece -> its probabilities, or () where the end is no piece itself.
        self.ends: dict[str, tuple] = {p[i:]: () for p in vocabulary for i in range(len(p))}
        self.ends |= self.table
        self.prefixes: dict[str, list[float]] = {}

    def word(self, word: str) -> list[float]:
        """Log-probabilities of a word: forward sums over all segmentations, one per language."""
        s, get, longest, seen = "▁" + word, self.ends.get, self.longest, self.prefixes
        k, n = len(self.languages), len(word) + 1
        unknown = (UNKNOWN,) * k
        alpha: list[list[float]] = [[1.0] * k]
        # the sums of a prefix are the same in all words that begin with it
        while len(alpha) < KNOWN and len(alpha) <= n and (known := seen.get(s[: len(alpha)])):
            alpha.append(known)
        scale = [0.0] * k
        for j in range(len(alpha), n + 1):
            total = None
            for i in range(j - 1, -1, -1):
                p = get(s[i:j])
                if not p:
                    if i == j - 1 and p is None:
                        p = unknown
                    elif i == j - 1:  # the end of a piece, but no piece
                        total = [x * UNKNOWN for x in alpha[i]]
                        continue
                    elif p is None:
                        break
                    else:
                        continue
                a = alpha[i]
                total = [x * y for x, y in zip(a, p)] if total is None else [t + x * y for t, x, y in zip(total, a, p)]
            if j < KNOWN:
                if len(seen) > PREFIXES:
                    seen.clear()
                seen[s[:j]] = total
            elif min(total) < _TINY:
                # a language's sums in use are lifted together
                lift = [_BOOST if x < _TINY else 1.0 for x in total]
                scale = [x - log(y) for x, y in zip(scale, lift)]
                for i in range(max(0, j - longest), j):
                    alpha[i] = [x * y for x, y in zip(alpha[i], lift)]
                total = [x * y for x, y in zip(total, lift)]
            alpha.append(total)
        return [log(max(x, 1e-300)) + y for x, y in zip(alpha[-1], scale)]


def _expected(word: str, count: float, probability: dict[str, float], ends: set[str], into: dict[str, float]) -> None:
    """Adds the expected uses of each piece in a word of one language."""
    s = "▁" + word
    for begin in range(0, len(s), PART):
        _expected_part(s[begin : begin + PART], count, probability, ends, into)


def _expected_part(s: str, count: float, probability: dict[str, float], ends: set[str], into: dict[str, float]) -> None:
    n = len(s)
    arcs: list[list[tuple[int, float | None]]] = []
    for j in range(1, n + 1):
        row = []
        for i in range(j - 1, -1, -1):
            p = probability.get(s[i:j])
            if p is not None or i == j - 1:
                row.append((i, p))
            if s[i:j] not in ends:
                break
        arcs.append(row)
    alpha, beta = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for j in range(1, n + 1):
        alpha[j] = sum(alpha[i] * (UNKNOWN if p is None else p) for i, p in arcs[j - 1])
    if alpha[n] <= 0.0:
        return
    for j in range(n, 0, -1):
        for i, p in arcs[j - 1]:
            weight = (UNKNOWN if p is None else p) * beta[j]
            beta[i] += weight
            if p is not None:
                x = s[i:j]
                into[x] = into.get(x, 0.0) + count * alpha[i] * weight / alpha[n]


def may_learn(key: str) -> Column:
    """Rows that are not held out: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(key).cast("string")) % 4 != 2


def train(labelled: DataFrame, path: str, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages in ``labelled``; at most ``SAMPLE_DOCS`` documents of each language are read.

    Rows with a null id, text or language teach nothing. What comes to the driver is one row per piece and language.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.where(F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    ids = first_k(rows.select("key", "lang"), ["lang"], [F.xxhash64("key"), F.col("key")], SAMPLE_DOCS).select(
        F.col("key").alias("_key"), F.col("lang").alias("_lang")
    )
    ids = stable(ids.distinct())
    if fits(ids, 100_000):
        ids = F.broadcast(ids)
    sample = rows.join(ids, (F.col("key") == F.col("_key")) & (F.col("lang") == F.col("_lang")), "left_semi")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for language, t in zip(b["lang"], b["text"]):
                if found := words(t):
                    yield pd.DataFrame({"lang": language, "word": found})

    counts = sample.select("lang", "text").mapInPandas(split, "lang string, word string").groupBy("lang", "word").agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    # few rows, but much work on each: they are spread over all cores
    counts = stable(counts.repartition(spark.sparkContext.defaultParallelism, "lang", "word"))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    vocabulary = pieces(path)
    at = {p: i for i, p in enumerate(vocabulary)}
    ends = spark.sparkContext.broadcast({p[i:] for p in vocabulary for i in range(len(p))})
    probabilities = np.full((len(vocabulary), len(languages)), 1.0 / len(vocabulary))
    for _ in range(ROUNDS if languages else 0):
        tables = {x: dict(zip(vocabulary, probabilities[:, i].tolist())) for i, x in enumerate(languages)}
        shared = spark.sparkContext.broadcast(tables)

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[str, dict[str, float]] = {}
            for b in batches:
                for language, word, n in zip(b["lang"], b["word"], b["n"]):
                    _expected(word, n, shared.value[language], ends.value, sums.setdefault(language, {}))
            for language, found in sums.items():
                yield pd.DataFrame({"lang": language, "piece": list(found), "n": list(found.values())})

        got = counts.mapInPandas(expect, "lang string, piece string, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        use = np.zeros_like(probabilities)
        for r in got.collect():
            use[at[r["piece"]], languages.index(r["lang"])] = r["n"]
        common = (use.sum(1) + 0.5) / (use.sum() + 0.5 * len(vocabulary))
        probabilities = (use + SMOOTHING * common[:, None]) / (use.sum(0) + SMOOTHING)
    return Model(languages, vocabulary, probabilities)


class Scorer:
    def __init__(self, model: Model):
        self.m = model
        self.rows = np.zeros((REMEMBERED + 1, max(1, len(model.languages))))
        self.known = _Rows(self)

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = words(text) if text else []
        if not found or not self.m.languages:
            return UNDETERMINED, 0.0
        total, letters = 0.0, False
        for begin in range(0, len(found), 50_000):
            if len(self.known) > REMEMBERED - 50_000 or self.known.letters > LETTERS:
                self.known.clear()
                self.known.letters = 0
            some = found[begin : begin + 50_000]
            at = np.fromiter(map(self.known.__getitem__, some), dtype=np.int64, count=len(some))
            letters = letters or bool(at.any())
            total = total + self.rows[at].sum(0)
        if not letters:
            return UNDETERMINED, 0.0
        best = int(np.argmax(total))
        return self.m.languages[best], float(1.0 / np.exp(np.maximum(total - total[best], -700)).sum())


class _Rows(dict):
    def __init__(self, scorer: Scorer):
        super().__init__()
        self.s, self.letters = scorer, 0

    def __missing__(self, word):
        if any(map(str.isalpha, word)):
            at = len(self) + 1
            self.s.rows[at] = self.s.m.word(word)
        else:
            at = 0
        self[word] = at
        self.letters += len(word)
        return at


def predictor(spark, model: Model):
    """A column function from a text to ``struct(lang, score)``.

    The model has one row per piece of the vocabulary and language; that is what is sent to the tasks.
    """
    shared, name = spark.sparkContext.broadcast(model), uuid4().hex

    @F.arrow_udf(StructType().add("lang", StringType()).add("score", DoubleType()))
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = held(name, lambda: Scorer(shared.value))
        for batch in batches:
            out = [run(t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["lang", "score"]
            )

    return predict


def identify(docs: DataFrame, path: str, *keep: str, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``keep, held_out, lang_pred, score`` of every row; learned from the rows that are not held out.

    Null texts and texts without a letter, or a table without a labelled text, give ``und`` and 0. Rows with a null id are
    not held out and not learned from. Repeated rows are predicted each; columns beside those named do not matter.
    """
    model = train(docs.where(may_learn(key)), path, key, text, lang)
    predict = predictor(docs.sparkSession, model)
    held = F.coalesce(~may_learn(key), F.lit(False))
    wide = docs.select(*keep, held.alias("held_out"), F.col(text).alias("text"))
    found = texts(wide, *keep, "held_out").select(*keep, "held_out", predict("text").alias("r"))
    return found.select(*keep, "held_out", F.col("r.lang").alias("lang_pred"), F.col("r.score").alias("score"))


def kept_languages(docs: DataFrame, path: str, least: float = 0.5, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows whose language is undetermined or less than ``least`` likely; ``lang`` becomes the prediction.

    All columns come back, whatever their names; null ids and repeated rows keep their rows.
    """
    model = train(docs.where(may_learn(key)), path, key, text, lang)
    # not deterministic to the planner, so that the filter stays above it and a text is scored once
    predict = predictor(docs.sparkSession, model).asNondeterministic()
    found = docs.select(F.struct(*docs.columns).alias("row"), predict(F.col(text)).alias("found"))
    found = found.where((F.col("found.lang") != UNDETERMINED) & (F.col("found.score") >= least))
    return found.select(*[F.col("found.lang").alias(c) if c == lang else F.col("row")[c].alias(c) for c in docs.columns])
