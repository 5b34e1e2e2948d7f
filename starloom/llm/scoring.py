"""Scores of texts under a smoothed unigram model and a log-bilinear model.

Word counts are taken over all training documents. The log-bilinear model has two
levels over all words: it predicts the next word's class from the class of the
word before, and the word from its class. The most frequent words and the end of
a text are classes of their own; every other word belongs to the class of its
longest ending (three bytes, two, one) that is frequent in the corpus, so that
also a rare or unseen word has a class as context and as target, in any task and
without a table of words. The number of endings grows with the root of the number
of distinct words. Training data are the counts of all neighbouring class pairs
and the members of the classes with their counts, a table of all words.
Noise-contrastive estimation with the class frequencies as noise is done on the
pair counts at once, so each step is a few matrix products and sees the whole
corpus. Normalising the matrix of all scores gives log-probabilities for every
pair, which scoring looks up. A word of an ending gets its class's probability
times its share of the counts of the class's members, unseen ones counted as one
more member, so that probabilities add up to one over all words.

A word is known by the 64-bit hash of its lower-cased bytes. The most frequent
ones go with each task, up to a bound; the others are joined by a shuffle. So no
frequent word is a hot key, and no count table of unbounded size is broadcast.

Edge cases: a null or blank text consists of its end; a null id is never held
out; without training documents every base score is 0 per token; repeated rows
are counted and scored as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import map_batches, prepare, texts_of
from starloom.llm.textscan import Words, chunks, hash_of
from starloom.session import stage

# A line end is part of no word, so its hash stands for the end of a text.
END = int(np.uint64(hash_of(b"\n")).view(np.int64))


@dataclass(frozen=True)
class Scoring:
    # Words that are classes of their own; all other words are in the classes of their endings.
    classes: int = 512
    # Endings are the root of the number of distinct words, within these bounds, so that the matrix of class pairs fits.
    least_endings: int = 64
    most_endings: int = 1_024
    # So many frequent words, 16 bytes each, go with the tasks.
    frequent_words: int = 500_000
    width: int = 16
    noise: float = 10.0
    steps: int = 200
    rate: float = 0.05
    folds: int = 5
    held_fold: int = 1


def held_out(key: str, how: Scoring) -> Column:
    digits = F.col(key).cast("string").cast("binary")
    return F.coalesce(F.crc32(digits) % how.folds == how.held_fold, F.lit(False))


def _scans(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch, "_text")]
    for first, last in chunks(texts):
        yield first, last, Words(texts[first:last], lower=True)


def endings_of(scan: Words) -> np.ndarray:
    """The last three bytes of each word as a number, the last one lowest; zero where a word is shorter."""
    out = np.zeros(len(scan.starts), np.int64)
    for k in range(3):
        places = scan.ends - 1 - k
        inside = places >= scan.starts
        out[inside] |= scan.data[places[inside]].astype(np.int64) << (8 * k)
    return out


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n, ending) over all training texts; the end of a text counts as a word."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scans = [(scan.hashes, endings_of(scan)) for _, _, scan in _scans(batch)]
        found, ends = (np.concatenate(c) for c in zip(*scans, strict=True))
        words, at, n = np.unique(found.view(np.int64), return_index=True, return_counts=True)
        words, n, ends = np.append(words, END), np.append(n, batch.num_rows), np.append(ends[at], 0)
        columns = [pa.array(words), pa.array(n, pa.int64()), pa.array(ends, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n", "ending"])

    found = map_batches(training.select("_text"), work, "word long, n long, ending long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.min("ending").alias("ending"))


def frequent_words(counts: DataFrame, limit: int) -> DataFrame:
    """The words of counts above a frequency that at most limit words reach.

    The frequency is read from a histogram over steps of a 64th of a doubling,
    so that no task sends more than its share of the words.
    """
    step = F.floor(F.log2("n") * 64).cast("int")
    histogram = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    total, least = 0, None
    for row in histogram:
        total += row["count"]
        if total > limit:
            break
        least = row["step"]
    return counts.filter(step >= least) if least is not None else counts.limit(0)


class Lookup:
    """Values by sorted 64-bit keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __call__(self, asked: np.ndarray, missing: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(asked), missing, np.int64)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.values[at], missing)


class Classes:
    """The class of every word: words of their own first, then endings, the longest that is listed, then all other words."""

    def __init__(self, words: np.ndarray, endings: list[np.ndarray]):
        """endings: those of three, two and one byte."""
        self.own = len(words)
        self.words = Lookup(words, np.arange(len(words)))
        places = np.split(np.arange(sum(map(len, endings))), np.cumsum([len(e) for e in endings])[:-1])
        self.endings = [Lookup(e, self.own + at) for e, at in zip(endings, places, strict=True)]
        self.size = self.own + sum(map(len, endings)) + 1

    def __call__(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        found = np.full(len(words), self.size - 1, np.int64)
        for width, listed in ((1, self.endings[2]), (2, self.endings[1]), (3, self.endings[0])):
            places = listed(endings & ((1 << 8 * width) - 1), -1)
            found = np.where(places >= 0, places, found)
        places = self.words(words, -1)
        return np.where(places >= 0, places, found)


def choose_classes(counts: DataFrame, words: np.ndarray, amount: int) -> Classes:
    """The given words, and about amount endings: those that most tokens have which no class before them holds."""
    rest = counts.filter(~F.col("word").isin([END, *words.tolist()]))
    endings = []
    for width, limit in ((3, amount // 2), (2, amount * 3 // 8), (1, amount - amount // 2 - amount * 3 // 8)):
        ending = F.col("ending").bitwiseAND((1 << 8 * width) - 1).alias("ending")
        top = rest.groupBy(ending).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "ending").limit(limit).collect()
        endings.append(np.array([r["ending"] for r in top], np.int64))
        rest = rest.filter(~ending.isin(endings[-1].tolist())) if top else rest
    return Classes(words, endings)


def class_masses(counts: DataFrame, classes: Classes) -> np.ndarray:
    """Of each class the smoothed counts of its members, those of unseen words counted as one more; from all counted words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, n, endings = (batch.column(c).to_numpy() for c in ("word", "n", "ending"))
        places, at = np.unique(classes(words, endings), return_inverse=True)
        sums, members = np.bincount(at, n, len(places)), np.bincount(at, minlength=len(places))
        return pa.RecordBatch.from_arrays([pa.array(places), pa.array(sums + 0.5 * members)], ["class", "mass"])

    found = map_batches(counts.filter(F.col("word") != END), work, "class long, mass double").groupBy("class").agg(F.sum("mass").alias("mass"))
    masses = np.full(classes.size, 0.5)
    for row in found.collect():
        masses[row["class"]] += row["mass"]
    return masses


def sequences(scan: Words, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class before, class, place of each text's first token) for the tokens of some texts, ends included.

    Classes below size hold words, size is the end, size + 1 the start.
    """
    texts = len(scan.bounds) - 1
    firsts = scan.bounds[:-1] + np.arange(texts)
    current = np.full(len(scan.hashes) + texts, classes.size, np.int64)
    places = np.arange(len(scan.hashes)) + scan.owners()
    current[places] = classes(scan.hashes.view(np.int64), endings_of(scan))
    before = np.empty_like(current)
    before[1:] = current[:-1]
    before[firsts] = classes.size + 1
    return before, current, firsts


def pair_counts(training: DataFrame, classes: Classes) -> DataFrame:
    """(pair, n): how often class pair // (size + 2) is followed by class pair % (size + 2), over all training texts."""
    whole = classes.size + 2

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(whole * whole, np.int64)
        for _, _, scan in _scans(batch):
            before, current, _ = sequences(scan, classes)
            pairs, n = np.unique(before * whole + current, return_counts=True)
            total[pairs] += n
        pairs = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total[pairs])], ["pair", "n"])

    return map_batches(training.select("_text"), work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


class LogBilinear:
    """Scores r(before) C q(next) + b(next), trained by noise-contrastive estimation on pair counts."""

    def __init__(self, size: int, how: Scoring):
        random = np.random.default_rng(5)
        self.how = how
        self.weights = {
            "context": random.normal(0, 0.1, (size, how.width)),
            "middle": np.eye(how.width),
            "target": random.normal(0, 0.1, (size, how.width)),
            "bias": np.zeros(size),
        }

    def fit(self, counts: np.ndarray) -> list[float]:
        """counts[before, next]; the objective after each step."""
        how, w = self.how, self.weights
        total = max(counts.sum(), 1.0)
        noise = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * len(counts))
        data = counts / total
        against = how.noise * data.sum(1)[:, None] * noise[None, :]
        shift = np.log(how.noise * noise)
        w["bias"] = np.log(noise)
        mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
        course = []
        for step in range(1, how.steps + 1):
            seen = w["context"] @ w["middle"]
            odds = np.clip(seen @ w["target"].T + w["bias"] - shift, -30, 30)
            real = 1 / (1 + np.exp(-odds))
            course.append(float((data * np.log(real)).sum() + (against * np.log1p(-real)).sum()))
            pull = data * (1 - real) - against * real
            grads = {
                "context": pull @ w["target"] @ w["middle"].T,
                "middle": w["context"].T @ pull @ w["target"],
                "target": pull.T @ seen,
                "bias": pull.sum(0),
            }
            for name, grad in grads.items():
                mean[name] = 0.9 * mean[name] + 0.1 * grad
                square[name] = 0.99 * square[name] + 0.01 * grad * grad
                change = mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-12)
                w[name] = w[name] + how.rate * (1 - 0.9 * step / how.steps) * change
        return course

    def log_probabilities(self) -> np.ndarray:
        """Normalised natural log-probabilities [before, next]; the start, the last class, never comes next."""
        w = self.weights
        scores = w["context"] @ w["middle"] @ w["target"].T + w["bias"]
        scores[:, -1] = -np.inf
        top = scores.max(1, keepdims=True)
        return scores - top - np.log(np.exp(scores - top).sum(1, keepdims=True))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Scoring = Scoring()) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs."""
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(key).alias("_id"), held_out(key, how).alias("held_out"), F.col(text).alias("_text"))
    training = source.filter("not held_out")
    counts = stage(word_counts(training), "word-counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    scale = tokens + 0.5 * (distinct + 1)
    top = frequent_words(counts.select("word", "n"), how.frequent_words).toArrow()
    words, n = top.column("word").to_numpy(), top.column("n").to_numpy()
    if END not in words:
        ends = counts.filter(F.col("word") == END).first()
        words, n = np.append(words, END), np.append(n, ends["n"] if ends else 0)
    ranked = np.lexsort((words, -n))
    chosen = words[ranked][words[ranked] != END][: how.classes]
    amount = min(max(math.isqrt(distinct), how.least_endings), how.most_endings)
    classes = choose_classes(counts, chosen, amount)
    frequent, whole = Lookup(words, n), classes.size + 2

    pairs = pair_counts(training, classes).toArrow()
    table = np.zeros(whole * whole)
    table[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    model = LogBilinear(whole, how)
    model.fit(table.reshape(whole, whole))
    logs = model.log_probabilities() / np.log(10)
    # The share of the unigram mass that a class's members have: what is left of a word's own share is that within its class.
    logs[:, classes.own : classes.size] -= np.log10(class_masses(counts, classes)[classes.own :] / scale)

    sent = spark.sparkContext.broadcast((frequent, classes, logs))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        frequent, classes, logs = sent.value
        columns: list[list] = [[] for _ in range(5)]
        rare_words, rare_counts = [], []
        for first, last, scan in _scans(batch):
            texts, owner, words = last - first, scan.owners(), scan.hashes.view(np.int64)
            before, current, firsts = sequences(scan, classes)
            model_part = np.add.reduceat(logs[before, current], firsts)
            seen = frequent(words, -1)
            own = np.log10((np.maximum(seen, 0) + 0.5) / scale)
            common = seen >= 0
            end = frequent(np.array([END]), 0)[0]
            base_part = np.bincount(owner[common], own[common], texts) + np.log10((end + 0.5) / scale)
            other = common & (classes.words(words, -1) < 0)
            model_part = model_part + np.bincount(owner[other], own[other], texts)
            known = np.bincount(owner[seen > 0], minlength=texts) + int(end > 0)
            for column, values in zip(columns, (scan.counts() + 1, known, base_part, model_part), strict=False):
                column.append(values)
            at = np.flatnonzero(~common)
            order = at[np.lexsort((words[at], owner[at]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (words[order][1:] != words[order][:-1])
            starts = np.flatnonzero(fresh)
            amounts = np.diff(np.append(starts, len(order)))
            bounds = np.searchsorted(owner[order][starts], np.arange(texts + 1))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                rare_words.append(words[order][starts][a:b])
                rare_counts.append(amounts[a:b])
        numbers = [pa.array(np.concatenate(c)) for c in columns[:4]]
        lists = [pa.array(rare_words, pa.list_(pa.int64())), pa.array(rare_counts, pa.list_(pa.int64()))]
        names = ["_row", "_id", "held_out", "n_tokens", "_known", "_base", "_model", "_words", "_amounts"]
        return pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)] + numbers + lists, names)

    kind = source.schema["_id"].dataType.simpleString()
    schema = (
        f"_row long, _id {kind}, held_out boolean, n_tokens long, _known long, _base double, _model double, "
        "_words array<long>, _amounts array<long>"
    )
    rows = source.select(F.monotonically_increasing_id().alias("_row"), "_id", "held_out", "_text")
    rows = stage(map_batches(rows, work, schema), "scores")
    rare = rows.select("_row", F.explode(F.arrays_zip("_words", "_amounts")).alias("w"))
    rare = rare.select("_row", F.col("w._words").alias("word"), F.col("w._amounts").alias("k"))
    found = rare.join(counts, "word", "left").select(
        "_row",
        (F.col("k") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / scale)).alias("value"),
        F.when(F.col("n") > 0, F.col("k")).otherwise(0).alias("known"),
    )
    sums = found.groupBy("_row").agg(F.sum("value").alias("_rare"), F.sum("known").alias("_rare_known"))
    scored = rows.drop("_words", "_amounts").join(sums, "_row", "left")
    rest = F.coalesce("_rare", F.lit(0.0))
    return scored.select(
        F.col("_id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("_known") + F.coalesce("_rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + rest).alias("base_score"),
        (F.col("_model") + rest).alias("score"),
    )
