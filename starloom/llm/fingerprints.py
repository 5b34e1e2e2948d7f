"""Homomorphic multiset fingerprints of documents.

A paragraph (a line with at least one word) is hashed to a wide vector, and a
document's fingerprint is the sum of its paragraphs' vectors modulo powers of
two. The sum does not depend on their order, and a paragraph is inserted or
deleted by adding or subtracting its vector. The lanes come in two groups:

* 16 digest lanes modulo 2**64, uniform values from an extendable-output hash of
  the paragraph. Equal multisets agree. A difference of one paragraph's count by
  k is missed with probability 2**(16 z - 1024), z being the number of times two
  divides k: never in practice below 2**64 copies.
* 128 sign lanes modulo 2**16, the sums over the paragraph's runs of three words
  of +1 or -1 from the run's hash. Read as signed numbers they are a random
  projection of the multiset of runs, so likeness, 2ab / (aa + bb), can be
  estimated from two fingerprints alone, with an error of about 0.1.

A fingerprint is stored as 192 words of 16 bits, four to a digest lane.

Edge cases: a null text is empty, and an empty or blank text has the zero
fingerprint; two zero fingerprints have likeness 1. A sign lane holds sums up to
32,767 in size, far above the root of most texts' length. One run repeated more
often wraps, which blurs the likeness of such a text, but not equality.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import prepare
from starloom.llm.textscan import Words, chunks, mix

DIGEST_WORDS, SIGN_LANES = 64, 128
RUN = 3


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """uint16 [texts, DIGEST_WORDS + SIGN_LANES]: the fingerprint of each UTF-8 text."""
    out = np.zeros((len(texts), DIGEST_WORDS + SIGN_LANES), np.uint16)
    for first, last in chunks(texts, 1 << 19):
        for k in range(first, last):
            parts = [line for line in texts[k].split(b"\n") if line.strip(b" \t\x0b\x0c\r")]
            if parts:
                raw = b"".join([hashlib.shake_128(line).digest(2 * DIGEST_WORDS) for line in parts])
                lanes = np.frombuffer(raw, "<u8").reshape(len(parts), -1).sum(0, dtype="<u8")
                out[k, :DIGEST_WORDS] = lanes.view("<u2")
        out[first:last, DIGEST_WORDS:] = _signs(texts[first:last])
    return out


def _signs(texts: list[bytes]) -> np.ndarray:
    """The sign lanes: each paragraph's word runs, summed over the paragraphs."""
    lines = [text.split(b"\n") for text in texts]
    hashes, bounds = Words([line for own in lines for line in own]).shingles(RUN)
    edges = bounds[np.concatenate(([0], np.cumsum([len(own) for own in lines])))]
    out = np.zeros((len(texts), SIGN_LANES), np.uint16)
    filled = np.flatnonzero(np.diff(edges))
    if not len(filled):
        return out
    for lane in range(0, SIGN_LANES, 64):
        bits = np.unpackbits(mix(hashes + np.uint64(lane + 1)).view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, edges[:-1][filled], axis=0, dtype=np.uint16)
        out[filled, lane : lane + 64] = 2 * ones - np.diff(edges)[filled].astype(np.uint16)[:, None]
    return out


def insert(fingerprint: np.ndarray, paragraph: str) -> np.ndarray:
    """The fingerprint with one more paragraph."""
    return _combine(np.add, fingerprint, paragraph)


def delete(fingerprint: np.ndarray, paragraph: str) -> np.ndarray:
    """The fingerprint with one paragraph less."""
    return _combine(np.subtract, fingerprint, paragraph)


def _combine(change: np.ufunc, fingerprint: np.ndarray, paragraph: str) -> np.ndarray:
    """Each lane changed by the paragraph's, digest lanes in 64 bits, sign lanes in 16."""
    own = fingerprints([paragraph.encode()])[0]
    digest = change(fingerprint[:DIGEST_WORDS].view("<u8"), own[:DIGEST_WORDS].view("<u8"))
    return np.concatenate((digest.view("<u2"), change(fingerprint[DIGEST_WORDS:], own[DIGEST_WORDS:])))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common word runs, 0 to 1, for rows of two arrays; 1 exactly if the fingerprints are equal."""
    x = a[:, DIGEST_WORDS:].view(np.int16).astype(np.float64)
    y = b[:, DIGEST_WORDS:].view(np.int16).astype(np.float64)
    whole = (x * x + y * y).sum(1)
    near = np.divide(2 * (x * y).sum(1), whole, out=np.zeros(len(x)), where=whole > 0)
    return np.where((a == b).all(1), 1.0, np.clip(near, 0, 1))


def _hot_keys(base: DataFrame, doubled: np.ndarray, limit: int) -> dict[int, int]:
    """Rows of each key above the limit. Only keys whose quantile repeats can be; quantiles are rounded to doubles."""
    if not len(doubled):
        return {}
    near = base.filter(F.col("_id").cast("double").isin([float(cut) for cut in doubled]))
    counted = near.groupBy("_id").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    return {r["_id"]: r["n"] for r in counted.collect()}


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_part, _tail, _id, _text), sorted by descending _id inside each task, each _part whole in one task.

    The rows are dealt to ranges of the key, four to a shuffle partition. The
    first row of a range is sent along to the range before it as a tail row, so
    that every row's successor (the first range's first row after the last one)
    follows it in the same task. The driver holds few keys per range. Rows with
    equal keys are ordered by text; rows without a key come last.

    A key that fills more than one range, and rows without a key, are cut into
    ranges of the text's hash; texts are read to find the ranges only then.
    Fully equal rows stay in one range.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = F.percentile_approx("_id", [k / ranges for k in range(1, ranges)], 10_000)
    found, rows, keyed = base.agg(quantiles, F.count("*"), F.count("_id")).first()
    cuts, copies = np.unique(np.array(found or [], np.int64), return_counts=True)
    hot = _hot_keys(base, cuts[copies > 1], rows // ranges)
    cuts = np.union1d(cuts, np.array(sorted(hot), np.int64))
    # Ranges of the text's hash per cut; the last entry is for rows without a key.
    share = [hot.get(int(cut), 0) for cut in cuts] + [rows - keyed]
    pieces = np.array([-(-ranges * count // rows) if rows else 0 for count in share], np.int64)
    spread = F.lit(0).cast("long")
    if pieces.any():
        spread = F.when(F.col("_id").isNull() | F.col("_id").isin([int(k) for k in hot]), F.xxhash64("_text")).otherwise(0)

    @F.pandas_udf("long")
    def place(ids: pd.Series, known: pd.Series, hashes: pd.Series) -> pd.Series:
        values, known = ids.to_numpy(np.int64), known.to_numpy(bool)
        below = np.searchsorted(cuts, values, "right")
        at_cut = known & (below > 0)
        at_cut[at_cut] = cuts[below[at_cut] - 1] == values[at_cut]
        count = np.where(known, 0, pieces[-1])
        count[at_cut] = pieces[below[at_cut] - 1]
        piece = np.floor((hashes.to_numpy(np.float64) / 2.0**64 + 0.5) * count).clip(0, np.maximum(count - 1, 0))
        order = np.where(known, len(cuts) - below, len(cuts) + 1)
        return pd.Series(order * (ranges + 2) + np.where(count > 0, piece.astype(np.int64) + 1, 0))

    where = place(F.coalesce("_id", F.lit(0)), F.col("_id").isNotNull(), "_hash")
    placed = base.withColumn("_hash", spread).withColumn("_part", where)
    heads = placed.groupBy("_part").agg(F.max("_id").alias("first"), F.min("_hash").alias("hash")).collect()
    firsts = {r["_part"]: (r["first"], r["hash"]) for r in heads}
    parts = sorted(firsts)
    before = {part: parts[k - 1] for k, part in enumerate(parts)}
    if not parts:
        return placed.withColumn("_tail", F.lit(False)).select("_part", "_tail", "_id", "_text")
    lookup = spark.createDataFrame(
        [(p, *firsts[p], before[p]) for p in parts], "_part long, _first long, _first_hash long, _before long"
    )
    joined = placed.join(F.broadcast(lookup), "_part")
    homes = F.array(F.struct(F.col("_part").alias("part"), F.lit(False).alias("tail")))
    tail = F.array(F.struct(F.col("_before").alias("part"), F.lit(True).alias("tail")))
    is_first = F.col("_id").eqNullSafe(F.col("_first")) & (F.col("_hash") == F.col("_first_hash"))
    both = F.when(is_first, F.concat(homes, tail)).otherwise(homes)
    sent = joined.select(F.explode(both).alias("home"), "_id", "_text").select("home.part", "home.tail", "_id", "_text")
    sent = sent.toDF("_part", "_tail", "_id", "_text").repartition(ranges // 4, "_part")
    return sent.sortWithinPartitions("_part", "_tail", F.col("_id").desc_nulls_last(), F.xxhash64("_text"), "_text")


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness.

    The edited text has the last half of the code points replaced by as many, or
    all, of the first ones of the next document by descending key.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("_part", "_tail", "_id", "_text")]
            rows = list(zip(*columns, strict=True))
            if held:
                rows.insert(0, held)
            if rows:
                yield _edited(rows)
                held = rows[-1] if not rows[-1][1] else None
        # Each range ends with a tail row, so nothing is left over.

    schema = (
        "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next(docs, key, text).mapInArrow(run, schema).withColumnRenamed("_id", key)


def _edited(rows: list[tuple]) -> pa.RecordBatch:
    """Results of all rows that are followed by a row of their range."""
    own = [k for k in range(len(rows) - 1) if not rows[k][1]]
    texts = [rows[k][3] for k in own]
    edited = [t[: len(t) - len(t) // 2] + rows[k + 1][3][: len(t) // 2] for k, t in zip(own, texts, strict=True)]
    prints = fingerprints([row[3].encode("utf-8", "surrogatepass") for row in rows])
    changed = [t.encode("utf-8", "surrogatepass") for t in edited]
    marks = fingerprints(changed)
    mine = prints[own]
    following = prints[[k + 1 for k in own]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[k][2] for k in own], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
            pa.array([row.tobytes().hex() for row in mine], pa.string()),
            pa.array([row.tobytes().hex() for row in marks], pa.string()),
            pa.array(likeness(mine, marks), pa.float64()),
            pa.array(likeness(mine, following), pa.float64()),
        ],
        ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
