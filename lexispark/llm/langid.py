"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities over the pieces of one fixed public vocabulary.  The probability of a word is the sum over
all its segmentations into pieces (forward algorithm); that of a text is the product over its words, a word being a run of
letters, lower-cased, with the space in front of it.  Piece probabilities come from expectation-maximisation over the same
segmentations, on a sample of labelled texts: about SAMPLE texts a language and ALL_SAMPLES in all at most, taken by a
hash of the id; of a text with more than LONGEST characters the sample has a stretch of that length from a place set by the
hash, and letter runs longer than PIECE count in pieces of that length.  Only the sample is bounded; every text is scored
whole, and words of all lengths by the same sums.

Defined results: a null text, or one without letters (Unicode category L; digits, fractions and letter-like numerals are
none), is `und` with score 0; so is everything if no labelled text is there to learn from.  The score is the posterior
probability of the language under equal priors.  Ties go to the language that sorts first.  Repeated rows get equal
results; an empty table gives an empty result; extra columns stay as they are, except that those named lang_pred, score
and likely are replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from lexispark.llm.common import remembered, slices, utf8
from lexispark.llm.sentencepiece import MODEL, Vocabulary

SAMPLE, ALL_SAMPLES = 300, 6_000
LONGEST = 20_000
ROUNDS = 4
#: Pseudo-counts of the pooled distribution in each language's.
SMOOTHING = 500.0
UNKNOWN = 1e-9
REMEMBERED = 300_000
#: Word characters without decimal digits and underscores; some of them, as fractions, are no letters.
_LETTERS = re.compile(r"[^\W\d_]+")
#: Words up to this length are summed together, with probabilities times GAIN for each character so that none underflows.
_WINDOW, GAIN = 48, 1e4
PIECE = 47
#: A text is likely if its log probability a letter is at most so far below the least one of the texts learnt from.
MARGIN = 1.0


class Edges:
    """Segmentation lattices of many short words: an edge for each piece at each place."""

    def __init__(self, words: list[str], prefixes: dict[str, tuple[int, int]], unknown: int):
        word, start, end, piece = [], [], [], []
        for w, text in enumerate(words):
            n = len(text)
            for i in range(n):
                single = False
                for j in range(i + 1, n + 1):
                    found = prefixes.get(text[i:j])
                    if found is None:
                        break
                    if found[0] >= 0:
                        single |= j == i + 1
                        word.append(w), start.append(i), end.append(j), piece.append(found[0])
                if not single:
                    word.append(w), start.append(i), end.append(i + 1), piece.append(unknown)
        self.n, self.longest = len(words), max(map(len, words), default=0)
        self.length = np.array([len(w) for w in words], np.int64)
        cols = np.array([word, start, end, piece], np.int64).reshape(4, -1)
        self.word, self.start, self.end, self.piece = cols[:, np.lexsort((cols[0], cols[2]))]
        self.to = np.searchsorted(self.end, np.arange(self.longest + 2))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """p: probability of each piece (and of the unknown), by language in columns -> (word, place, language), times GAIN ** place."""
        a = np.zeros((self.n, self.longest + 1, p.shape[1]))
        gain = GAIN ** np.arange(self.longest + 1.0)
        a[:, 0] = 1
        for j in range(1, self.longest + 1):
            e = slice(self.to[j], self.to[j + 1])
            w = self.word[e]
            if len(w):
                terms = a[w, self.start[e]] * p[self.piece[e]] * gain[self.end[e] - self.start[e]][:, None]
                first = np.flatnonzero(np.diff(w, prepend=-1))
                a[w[first], j] = np.add.reduceat(terms, first, axis=0)
        return a

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, one language: p is a vector, counts of the words."""
        a = self.forward(p[:, None])[:, :, 0]
        gain, b = GAIN ** np.arange(self.longest + 1.0), np.zeros_like(a)
        b[np.arange(self.n), self.length] = 1
        order = np.lexsort((self.word, -self.start))
        word, start, end, piece = self.word[order], self.start[order], self.end[order], self.piece[order]
        at = np.searchsorted(-start, -np.arange(self.longest, -2, -1))
        for k in range(self.longest + 1):
            e = slice(at[k], at[k + 1])
            w = word[e]
            if len(w):
                terms = b[w, end[e]] * p[piece[e]] * gain[end[e] - start[e]]
                first = np.flatnonzero(np.diff(w, prepend=-1))
                b[w[first], start[e][0]] = np.add.reduceat(terms, first)
        z = a[np.arange(self.n), self.length]
        use = a[self.word, self.start] * p[self.piece] * gain[self.end - self.start] * b[self.word, self.end] / z[self.word] * counts[self.word]
        return np.bincount(self.piece, use, len(p))


def long_word(text: str, prefixes: dict, p: np.ndarray, unknown: int) -> np.ndarray:
    """log of the forward sum of one word of any length, by language; only as many places as a piece is long are kept."""
    live, log = {0: np.ones(p.shape[1])}, np.zeros(p.shape[1])
    for i in range(len(text)):
        here, single = live.pop(i), False
        log += np.log(here)
        live = {j: v / here for j, v in live.items()}
        here = np.ones_like(here)
        for j in range(i + 1, len(text) + 1):
            found = prefixes.get(text[i:j])
            if found is None:
                break
            if found[0] >= 0:
                single |= j == i + 1
                live[j] = live.get(j, 0) + here * p[found[0]]
        if not single:
            live[i + 1] = live.get(i + 1, 0) + here * p[unknown]
    return log + np.log(live[len(text)])


class Model:
    def __init__(self, languages: list[str], probabilities: np.ndarray, vocabulary: Vocabulary):
        """probabilities: pieces and the unknown, by language in columns."""
        self.languages, self.p, self.vocabulary = languages, probabilities, vocabulary
        #: By language, the least log probability a letter of the texts learnt from.
        self.least = np.full(len(languages), -np.inf)

    def words(self, words: list[str]) -> np.ndarray:
        """log probability of each word by language."""
        out = np.zeros((len(words), len(self.languages)))
        short = [k for k, w in enumerate(words) if len(w) <= _WINDOW]
        if short:
            lattice = Edges([words[k] for k in short], self.vocabulary.prefixes, len(self.p) - 1)
            a = lattice.forward(self.p)
            out[short] = np.log(a[np.arange(lattice.n), lattice.length]) - lattice.length[:, None] * math.log(GAIN)
        for k, w in enumerate(words):
            if len(w) > _WINDOW:
                out[k] = long_word(w, self.vocabulary.prefixes, self.p, len(self.p) - 1)
        return out


def letters(text: str) -> list[str]:
    """Runs of letters in lower case, with a space in front."""
    runs = _LETTERS.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, runs)):
        return [" " + w for w in runs]
    split = ("".join(c if c.isalpha() else " " for c in w).split() for w in runs)
    return [" " + w for words in split for w in words]


def fit(samples: list[tuple[str, str]], model: str = MODEL, rounds: int = ROUNDS) -> Model:
    """samples: (language, text)."""
    vocabulary = Vocabulary.load(model)
    size = len(vocabulary.spelled) + 1
    languages = sorted({lang for lang, _ in samples})
    counts: dict[str, dict[str, int]] = {lang: {} for lang in languages}
    for lang, text in samples:
        own = counts[lang]
        for word in letters(text):
            for k in range(0, len(word), PIECE):
                w = word[k : k + PIECE]
                own[w] = own.get(w, 0) + 1
    start = np.full(size, 1.0)
    start[list(vocabulary.pieces.values())] = [math.exp(-vocabulary.prefixes[t][1] / 1000) for t in vocabulary.pieces]
    start[-1] = 0
    start = start / start.sum()
    uses = []
    for lang in languages:
        words = list(counts[lang])
        n = np.array([counts[lang][w] for w in words], float)
        lattice = Edges(words, vocabulary.prefixes, size - 1)
        p = np.maximum(start, UNKNOWN)
        for _ in range(rounds):
            c = lattice.expected(p, n)
            c[-1] = 0
            p = np.maximum((c + SMOOTHING * start) / max(c.sum() + SMOOTHING, 1e-9), UNKNOWN)
        uses.append(c if len(words) else np.zeros(size))
    pooled = sum(uses, np.zeros(size)) + SMOOTHING * start
    pooled = pooled / pooled.sum()
    table = np.stack([(u + SMOOTHING * pooled) / (u.sum() + SMOOTHING) for u in uses], 1) if uses else np.zeros((size, 0))
    table = np.maximum(table, UNKNOWN)
    table[-1] = UNKNOWN
    made = Model(languages, table, vocabulary)
    made.least = Scorer(made).least(samples)
    return made


class Scorer:
    """Scores texts; remembers words, up to a fixed number."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.rows = np.zeros((1024, len(model.languages)))

    def _learn(self, new: list[str]) -> None:
        if len(self.place) + len(new) > REMEMBERED:
            self.place.clear()
        for k in range(0, len(new), 4096):
            part, n = new[k : k + 4096], len(self.place)
            while len(self.rows) < n + len(part):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[n : n + len(part)] = self.model.words(part)
            self.place.update(zip(part, range(n, n + len(part)), strict=True))

    def totals(self, texts: list[str | None]) -> list[tuple[np.ndarray, int] | None]:
        """Log probabilities by language and the number of letters; None without letters or languages."""
        found = [letters(t) if t else [] for t in texts]
        need = {w for words in found for w in words}
        new = [w for w in need if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            new = list(need)
        self._learn(new)
        out = []
        for words in found:
            if not words or not self.model.languages:
                out.append(None)
            else:
                total = self.rows[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(0)
                out.append((total, sum(map(len, words)) - len(words)))
        return out

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        langs, scores, likely = [], [], []
        for known in self.totals(texts):
            if known is None:
                langs.append("und"), scores.append(0.0), likely.append(False)
                continue
            total, n = known
            e = np.exp(total - total.max())
            best = int(total.argmax())
            langs.append(self.model.languages[best]), scores.append(float(e[best] / e.sum()))
            likely.append(bool(total[best] / n >= self.model.least[best] - MARGIN))
        return langs, scores, likely

    def least(self, samples: list[tuple[str, str]]) -> np.ndarray:
        out = np.full(len(self.model.languages), np.inf)
        for (lang, _), known in zip(samples, self.totals([t for _, t in samples]), strict=True):
            if known is not None:
                k = self.model.languages.index(lang)
                out[k] = min(out[k], known[0][k] / known[1])
        return np.where(np.isfinite(out), out, -np.inf)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, most: int = SAMPLE, in_all: int = ALL_SAMPLES) -> list[tuple[str, str]]:
    """About `most` labelled texts a language, `in_all` at most; the expected number is bounded whatever the size of docs."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    each = F.least(F.lit(float(most)), F.lit(float(in_all)) / F.count("*").over(Window.partitionBy())) / F.col("n")
    # Languages beyond in_all aren't looked at: the sample couldn't hold a text of each.
    share = counts.select(F.col("lang").alias("_l"), F.least(F.lit(1.0), each).alias("_share")).orderBy("_l").limit(in_all)
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(2**31))
    place = F.pmod(F.xxhash64(F.lit("stretch"), "doc_id"), F.greatest(F.length("text") - LONGEST, F.lit(0)) + 1)
    rows = known.join(F.broadcast(share), F.col("lang") == F.col("_l")).where(draw < F.col("_share") * 2**31)
    rows = rows.select("lang", F.col("text").substr((place + 1).cast("int"), F.lit(LONGEST)).alias("text")).collect()
    return sorted((r["lang"], r["text"]) for r in rows)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs -> the same columns, lang_pred, score and likely.  Clashing columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "likely")]
    docs = docs.select(*[f"`{f.name}`" for f in kept])
    at = [f.name for f in kept].index(text_col)
    schema = StructType(kept + [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("likely", BooleanType())])

    def run(batches):
        scorer = remembered(("scorer", id(shared.value)), lambda: Scorer(shared.value))
        for batch in batches:
            _, offsets = utf8(batch.column(at))
            for i, j in slices(offsets, 1 << 20):
                langs, scores, likely = scorer.score(batch.column(at).slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [c.slice(i, j - i) for c in batch.columns] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(likely, pa.bool_())],
                    names=batch.schema.names + ["lang_pred", "score", "likely"],
                )

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, most: int = SAMPLE, model: str = MODEL) -> DataFrame:
    """docs(doc_id, text, lang, ...) -> doc_id, text, held_out, lang_pred, score; learns from what isn't held out."""
    learnt = fit(sample(docs.where(~is_held_out(F.col("doc_id"))), most), model)
    return predict(docs.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out")), learnt)
