"""Severity of toxic language by cumulative-link ordinal regression.

Labels say whether a document is toxic; grades 1 to 3 split the toxic ones into
thirds by the density of marked words. Features are the words of a text (runs of
letters, lower case) and their four- and five-byte beginnings, so that stems
count whatever their ending; those most tied to the label (likelihood ratio) are
kept, as presence and as density. The model is P(grade <= k) = s(t_k - w x): one
weight vector shared by ordered thresholds t_0 < t_1 < t_2, fitted in numpy. It
gives each text the probabilities of all grades and the expected severity.

Features and weights are fitted on a bounded sample of labelled documents; every
text is scored whole.

Edge cases: a null or wordless text has no features; without labels of both
kinds every text has severity 0; a document labelled twice counts as toxic if
one label says so; labels other than 0 and 1 are ignored; repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import map_batches, prepare, texts_of
from starloom.llm.textscan import Words, chunks, mix
from starloom.session import stage

GRADES = 4


@dataclass(frozen=True)
class Fitting:
    sample_documents: int = 20_000
    features: int = 1_500
    # A feature must reach this likelihood ratio (chi-square, one degree of freedom: p < 1e-6) ...
    least_ratio: float = 24.0
    # ... and, to count as a marked word, be this many times as frequent among toxic documents.
    marked_lift: float = 8.0
    steps: int = 300
    rate: float = 0.1
    penalty: float = 1e-4


def _features(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, last text, owner and feature of every word and beginning, number of words per text)."""
    texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch, "_text")]
    for first, last in chunks(texts):
        scan = Words(texts[first:last], lower=True, words="letters")
        owner, owners, features = scan.owners(), [scan.owners()], [scan.hashes]
        for size in (4, 5):
            long = np.flatnonzero(scan.ends - scan.starts > size)
            begun = scan.hash_spans(scan.starts[long], scan.starts[long] + size)
            owners.append(owner[long])
            features.append(mix(begun + np.uint64(size)))
        yield first, last, np.concatenate(owners), np.concatenate(features).view(np.int64), scan.counts()


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, how: Fitting) -> DataFrame:
    """(_toxic, _text) of a bounded sample of labelled documents, by a hash of the key."""
    marks = labels.filter(F.col(key).isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(
        F.max("toxic").cast("int").alias("_toxic")
    )
    marks = stage(marks.withColumn("_draw", F.xxhash64("_key", F.lit(3))), "toxic-labels")
    chosen = marks.orderBy("_draw", "_key").limit(how.sample_documents).drop("_draw")
    joined = docs.join(F.broadcast(chosen), docs[key] == chosen["_key"])
    return stage(joined.select("_toxic", F.col(text).alias("_text")), "labelled-texts")


def feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): the documents of each kind that a feature occurs in."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic = np.array(batch.column("_toxic").to_pylist(), bool)
        found, kinds = [], []
        for first, last, owner, feature, _ in _features(batch):
            order = np.lexsort((feature, owner))
            owner, feature = owner[order], feature[order]
            fresh = np.ones(len(owner), bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])
            found.append(feature[fresh])
            kinds.append(toxic[first:last][owner[fresh]])
        features, place = np.unique(np.concatenate(found), return_inverse=True)
        bad = np.bincount(place, np.concatenate(kinds), len(features)).astype(np.int64)
        all_of = np.bincount(place, minlength=len(features))
        columns = [pa.array(features), pa.array(bad), pa.array(all_of - bad)]
        return pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "clean"])

    counts = map_batches(sample, work, "feature long, toxic long, clean long").groupBy("feature")
    return counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_features(counts: DataFrame, toxic: int, clean: int, how: Fitting) -> tuple[np.ndarray, np.ndarray]:
    """(features, sorted; which of them are marked words) by the likelihood ratio of occurrence against the label."""

    def part(seen: str, expected: str) -> str:
        return f"case when {seen} > 0 then {seen} * ln({seen} / ({expected})) else 0 end"

    n, both = toxic + clean, "(toxic + clean)"
    cells = [
        part("toxic", f"{both} * {toxic / n}D"), part("clean", f"{both} * {clean / n}D"),
        part(f"({toxic} - toxic)", f"({n} - {both}) * {toxic / n}D"), part(f"({clean} - clean)", f"({n} - {both}) * {clean / n}D"),
    ]
    lift = F.expr(f"(toxic / {toxic}D) / ((clean + 0.5D) / {clean}D)")
    rated = counts.withColumn("ratio", F.expr(f"2 * ({' + '.join(cells)})")).withColumn("marked", lift >= how.marked_lift)
    best = rated.filter(F.col("ratio") >= how.least_ratio).orderBy(F.desc("ratio"), "feature").limit(how.features).toArrow()
    features, marked = best.column("feature").to_numpy(), best.column("marked").to_numpy(zero_copy_only=False).astype(bool)
    order = np.argsort(features)
    return features[order], marked[order]


def _hits(batch: pa.RecordBatch, features: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, owner, place, times, words per text) of the chosen features in each text."""
    for first, last, owner, feature, words in _features(batch):
        at = np.minimum(np.searchsorted(features, feature), max(len(features) - 1, 0))
        hit = features[at] == feature if len(features) else np.zeros(len(feature), bool)
        pairs, times = np.unique(owner[hit] * max(len(features), 1) + at[hit], return_counts=True)
        yield first, last, pairs // max(len(features), 1), pairs % max(len(features), 1), times, words


def density(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.minimum(100 * times / np.maximum(words, 1), 10) / 10


@dataclass
class Ordinal:
    """Weights of presence and density per feature, and the thresholds between grades."""

    features: np.ndarray
    presence: np.ndarray
    dense: np.ndarray
    thresholds: np.ndarray

    def chances(self, score: np.ndarray) -> np.ndarray:
        """Probabilities of the grades [texts, GRADES]."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))
        return np.diff(np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], 1), axis=1)


def fit(features: np.ndarray, rows: np.ndarray, places: np.ndarray, share: np.ndarray, grades: np.ndarray, how: Fitting) -> Ordinal:
    """Maximum likelihood by Adam; rows, places and share list the features of the documents, grades their grades."""
    size, count = len(features), len(grades)
    values = {"presence": np.zeros(size), "dense": np.zeros(size), "first": np.zeros(1), "gaps": np.zeros(GRADES - 2)}
    share_of = np.bincount(grades, minlength=GRADES) / count
    values["first"][0] = np.log(max(share_of[0], 1e-3) / max(1 - share_of[0], 1e-3))
    mean, square = ({k: np.zeros_like(v) for k, v in values.items()} for _ in range(2))
    for step in range(1, how.steps + 1):
        thresholds = values["first"][0] + np.concatenate(([0], np.cumsum(np.exp(values["gaps"]))))
        score = np.bincount(rows, values["presence"][places] + values["dense"][places] * share, count)
        edges = np.concatenate(([-np.inf], thresholds, [np.inf]))
        with np.errstate(over="ignore"):
            upper = 1 / (1 + np.exp(-(edges[grades + 1] - score)))
            lower = 1 / (1 + np.exp(-(edges[grades] - score)))
        chance = np.maximum(upper - lower, 1e-12)
        to_upper, to_lower = upper * (1 - upper) / chance / count, lower * (1 - lower) / chance / count
        by_score = to_upper - to_lower  # of the negative log-likelihood
        by_edge = np.bincount(grades, -to_upper, GRADES)[: GRADES - 1] + np.bincount(grades, to_lower, GRADES)[1:]
        later = np.cumsum(by_edge[::-1])[::-1]
        grads = {
            "presence": np.bincount(places, by_score[rows], size) + how.penalty * values["presence"],
            "dense": np.bincount(places, by_score[rows] * share, size) + how.penalty * values["dense"],
            "first": later[:1],
            "gaps": later[1:] * np.exp(values["gaps"]),
        }
        for name, grad in grads.items():
            mean[name] = 0.9 * mean[name] + 0.1 * grad
            square[name] = 0.999 * square[name] + 0.001 * grad * grad
            change = mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-9)
            values[name] = values[name] - how.rate * change
    thresholds = values["first"][0] + np.concatenate(([0], np.cumsum(np.exp(values["gaps"]))))
    return Ordinal(features, values["presence"], values["dense"], thresholds)


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, how: Fitting) -> Ordinal | None:
    """The model of a bounded sample of labelled documents; None without labels of both kinds or telling features."""
    sample = labelled_sample(docs, labels, key, text, how)
    toxic, total = sample.agg(F.coalesce(F.sum("_toxic"), F.lit(0)), F.count("*")).first()
    if not toxic or toxic == total:
        return None
    features, marked = choose_features(feature_counts(sample), toxic, total - toxic, how)
    if not len(features):
        return None

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, shares, marks = [], [], []
        for first, last, owner, place, times, words in _hits(batch, features):
            share = density(times, words[owner])
            marks.append(np.bincount(owner, times * marked[place], last - first) / np.maximum(words, 1))
            bounds = np.searchsorted(owner, np.arange(last - first + 1))
            places += [place[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            shares += [share[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        columns = [
            batch.column("_toxic"), pa.array(np.concatenate(marks)), pa.array(places, pa.list_(pa.int64())), pa.array(shares, pa.list_(pa.float64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["toxic", "marks", "places", "shares"])

    rows = map_batches(sample, work, "toxic int, marks double, places array<long>, shares array<double>").toArrow()
    bad, marks = rows.column("toxic").to_numpy().astype(bool), rows.column("marks").to_numpy()
    cuts = np.quantile(marks[bad], [1 / 3, 2 / 3])
    grades = np.where(bad, 1 + np.searchsorted(cuts, marks, "left"), 0)
    lists = rows.column("places").combine_chunks()
    owner = np.repeat(np.arange(len(grades)), np.diff(lists.offsets.to_numpy()))
    shares = rows.column("shares").combine_chunks().flatten().to_numpy()
    return fit(features, owner, lists.flatten().to_numpy(), shares, grades, how)


def grade(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", how: Fitting = Fitting()) -> DataFrame:
    """(key, severity_grade, expected_severity, p_toxic, toxic) per row of docs.

    The model, some tens of kilobytes whatever the input, goes along with the task.
    """
    prepare(docs.sparkSession)
    model = train(docs, labels, key, text, how)
    source = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        chances = np.zeros((batch.num_rows, GRADES))
        chances[:, 0] = 1
        if model is not None:
            for first, last, owner, place, times, words in _hits(batch, model.features):
                value = model.presence[place] + model.dense[place] * density(times, words[owner])
                chances[first:last] = model.chances(np.bincount(owner, value, last - first))
        columns = [
            batch.column("_id"), pa.array(chances.argmax(1).astype(np.int32)), pa.array(chances @ np.arange(GRADES)),
            pa.array(1 - chances[:, 0]), pa.array(chances[:, 0] < 0.5),
        ]
        return pa.RecordBatch.from_arrays(columns, ["_id", "severity_grade", "expected_severity", "p_toxic", "toxic"])

    kind = source.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, severity_grade int, expected_severity double, p_toxic double, toxic boolean"
    return map_batches(source, work, schema).withColumnRenamed("_id", key)
