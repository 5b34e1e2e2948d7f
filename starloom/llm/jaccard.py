"""Join of documents by the Jaccard similarity of their word n-grams: MinHash banding, then exact verification.

1. Every text becomes the set of hashes of its word runs and a MinHash
   signature. Texts with the same set are one class text with a number of copies.
2. Bands of the signature are shuffled by their hashes. Buckets with several
   class texts are cut into blocks, and each pair of blocks is one unit of work,
   so no task needs a whole bucket; a unit compares signatures and returns a
   spanning forest of what may be similar, never the pairs.
3. The forests' components are cut into blocks by the size of their sets. Each
   pair of blocks compares the full sets and returns, per text, the number of
   texts (with copies) it is linked to and its smallest linked text.
4. Components of the verified links are the classes.

Banding finds a pair of similarity s with probability 1 - (1 - s**rows)**bands;
choose_bands picks rows and bands for a target recall at the threshold.
Signatures only discard pairs estimated more than margin below the threshold.
A pair in different candidate components shares no band, or was discarded.

Texts are told apart by their sets alone; ids only name classes and choose the row that
stays. A row is found again by a digest of its id and text.

Edge cases: a text of fewer than size words, but at least one, has one n-gram:
all its words. A null or blank text has none, is linked to nothing and is its
own class. Rows with a null id are linked and classified like others; a class has the
smallest id that is not null (null if all are), and where ids repeat, two classes may have
the same, so that class_key, the smallest key of its sets, tells classes apart. Different
texts under one id are different texts. Repeated rows count as copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import components, keep_ids, map_batches, prepare, texts_of
from starloom.llm.textscan import Words, chunks, mix
from starloom.session import stage


@dataclass(frozen=True)
class Similarity:
    threshold: float = 0.8
    words: int = 5
    target_recall: float = 0.9995
    max_hashes: int = 128
    # Signature estimates this far below the threshold are discarded: four standard deviations at 100 hashes.
    margin: float = 0.16
    # Work of one unit: class texts per block when signatures or sets are compared, n-grams per block.
    block_texts: int = 512
    block_ngrams: int = 400_000


def choose_bands(threshold: float, target_recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most selective rows for which bands * rows hashes reach the target at the threshold."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - target_recall) / math.log1p(-(threshold**rows)))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def signatures(hashes: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """MinHash values, uint32 [texts, size]; a text without n-grams has the largest value everywhere."""
    random = np.random.default_rng(7)
    multiply = random.integers(1 << 62, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full((len(bounds) - 1, size), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        starts = bounds[filled]
        work = np.empty_like(hashes)
        for k in range(size):
            np.multiply(hashes, multiply[k], out=work)
            out[filled, k] = np.minimum.reduceat(work, starts) >> np.uint64(32)
    return out


def _sketch(batch: pa.RecordBatch, words: int, bands: int, rows: int) -> pa.RecordBatch:
    texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch, "_text")]
    amounts, keys, signed = [], [], []
    for first, last in chunks(texts):
        hashes, bounds = Words(texts[first:last]).shingles(words)
        owners = np.repeat(np.arange(last - first), np.diff(bounds))
        order = np.lexsort((hashes, owners))
        hashes, owners = hashes[order], owners[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[fresh], owners[fresh]
        bounds = np.searchsorted(owners, np.arange(last - first + 1))
        amounts.append(np.diff(bounds))
        sums = np.zeros((2, len(hashes) + 1), np.uint64)
        for k in range(2):
            np.cumsum(mix(hashes + np.uint64(k + 1)), out=sums[k, 1:])
        totals = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
        keys.append(np.ascontiguousarray(totals.T).view("S16").ravel())
        signed.append(signatures(hashes, bounds, bands * rows))
    signature = np.concatenate(signed)
    raw = np.ascontiguousarray(np.concatenate(keys)).tobytes()
    width = bands * rows * 4
    packed = signature.tobytes()
    return pa.RecordBatch.from_arrays(
        [
            batch.column("_id"),
            batch.column("_key"),
            pa.array(np.concatenate(amounts), pa.int64()),
            pa.array([raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary()),
            pa.array([packed[i : i + width] for i in range(0, len(packed), width)], pa.binary()),
        ],
        ["_id", "_key", "n_ngrams", "set_key", "signature"],
    )


def row_key(key: str, text: str) -> Column:
    """A digest of a row's id and text."""
    return F.unhex(F.sha2(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))), 256))


def sketch(docs: DataFrame, key: str, text: str, how: Similarity) -> DataFrame:
    """(_id, _key, n_ngrams, set_key, signature) per row; set_key is equal for equal n-gram sets."""
    bands, rows = choose_bands(how.threshold, how.target_recall, how.max_hashes)
    source = docs.select(F.col(key).cast("long").alias("_id"), row_key(key, text).alias("_key"), F.col(text).alias("_text"))
    schema = "_id long, _key binary, n_ngrams long, set_key binary, signature binary"
    return map_batches(source, lambda batch: _sketch(batch, how.words, bands, rows), schema)


def _forest(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the smallest place in each place's component."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(axis=1) if len(label) else label
        lower = np.minimum(label, near)
        lower = np.minimum(lower, lower[lower])
        if np.array_equal(lower, label):
            return label
        label = lower


def _blocks(frame: DataFrame, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks that its own block is part of: columns _i <= _j and _own."""
    own = F.expr(f"cast(pmod(xxhash64(_rep, 11), {blocks}) as int)")
    other = F.explode(F.expr(f"sequence(0, cast({blocks} as int) - 1)"))
    return frame.withColumn("_own", own).withColumn("_other", other).withColumns(
        {"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}
    )


def _candidates(batch: pa.RecordBatch, least: float, width: int) -> Iterator[tuple[int, int]]:
    groups = batch.column("members")
    reps = groups.flatten().field("_rep").to_numpy(zero_copy_only=False)
    packed = np.frombuffer(b"".join(groups.flatten().field("signature").to_pylist()), np.uint32).reshape(-1, width)
    bounds = groups.offsets.to_numpy() - groups.offsets[0].as_py()
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        ids, signed = reps[first:last], packed[first:last]
        if len(ids) == 2:
            if (signed[0] == signed[1]).mean() >= least:
                yield int(ids.min()), int(ids.max())
            continue
        order = np.argsort(ids)
        ids, signed = ids[order], np.ascontiguousarray(signed[order].T)
        same = np.zeros((len(ids), len(ids)), np.uint16)
        for column in signed:
            same += column[:, None] == column[None, :]
        label = _forest(same >= least * width)
        for k in np.flatnonzero(label != np.arange(len(ids))):
            yield int(ids[label[k]]), int(ids[k])


def candidate_links(texts: DataFrame, how: Similarity) -> DataFrame:
    """(a, b): a spanning forest, by bucket and block pair, of class texts that may be similar."""
    bands, rows = choose_bands(how.threshold, how.target_recall, how.max_hashes)
    slices = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("signature"), k * (rows * 4) + 1, F.lit(rows * 4))),
    )
    banded = texts.select("_rep", F.explode(slices).alias("bucket"))
    live = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stage(banded.join(live, "bucket"), "buckets")
    signed = members.join(texts.select("_rep", "signature"), "_rep")
    units = _blocks(signed, f"ceil(n / {how.block_texts})").groupBy("bucket", "_i", "_j")
    units = units.agg(F.collect_list(F.struct("_rep", "signature")).alias("members")).filter("size(members) > 1")
    least, width = how.threshold - how.margin, bands * rows

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = sorted(set(_candidates(batch, least, width)))
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_batches(units.select("members"), work, "a long, b long")


def _sets(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch, "_text")]
    sets = []
    for first, last in chunks(texts):
        hashes, bounds = Words(texts[first:last]).shingles(words)
        sets += [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(sets, pa.binary())], ["_key", "ngrams"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections, by matrix products over slices of the shared n-grams."""
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    keep = shared[places]
    owners, columns = owners[keep], column[places[keep]]
    order = np.argsort(columns, kind="stable")
    owners, columns = owners[order], columns[order]
    out, step = np.zeros((len(sets), len(sets)), np.float32), 4096
    for first in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(columns, (first, first + step))
        dense = np.zeros((len(sets), min(step, int(shared.sum()) - first)), np.float32)
        dense[owners[a:b], columns[a:b] - first] = 1
        out += dense @ dense.T
    return out


def _verified(batch: pa.RecordBatch, threshold: float) -> Iterator[tuple[int, int, int]]:
    groups = batch.column("members")
    flat = groups.flatten()
    reps, copies, own = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("_rep", "copies", "_own"))
    ngrams = flat.field("ngrams")
    bounds = groups.offsets.to_numpy() - groups.offsets[0].as_py()
    for k, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        sets = [np.frombuffer(ngrams[i].as_py(), np.uint64) for i in range(first, last)]
        ids, blocks, weights = reps[first:last], own[first:last], copies[first:last]
        sizes = np.array([len(s) for s in sets], np.float64)
        common = overlaps(sets).astype(np.float64)
        linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
        np.fill_diagonal(linked, False)
        if batch.column("_i")[k].as_py() != batch.column("_j")[k].as_py():
            linked &= blocks[:, None] != blocks[None, :]
        amounts = linked @ weights
        smallest = np.where(linked, ids[None, :], np.iinfo(np.int64).max).min(axis=1)
        order = np.argsort(ids)
        label = np.empty(len(ids), np.int64)
        label[order] = ids[order][_forest(linked[np.ix_(order, order)])]
        for i in np.flatnonzero(amounts):
            yield int(ids[i]), int(amounts[i]), int(min(label[i], smallest[i]))


def _classified(docs: DataFrame, key: str, text: str, how: Similarity) -> DataFrame:
    """Every row's _id, _key, n_ngrams, class_id, class_key, n_links, and whether it is the one of its class that stays."""
    prepare(docs.sparkSession)
    rows = stage(sketch(docs, key, text, how), "sketch")
    place = F.struct(F.col("_id").isNull().alias("unnamed"), F.col("_id").alias("id"), F.col("_key").alias("key"))
    texts = rows.filter("n_ngrams > 0").groupBy("set_key").agg(
        F.min(place).alias("_first"), F.count("*").alias("copies"), F.first("n_ngrams").alias("n_ngrams"), F.first("signature").alias("signature"),
    )
    # Numbers that hold once they are written.
    texts = stage(texts.withColumn("_rep", F.monotonically_increasing_id()), "class-texts")
    links = candidate_links(texts, how)
    near = components(links, "a", "b")
    members = near.join(texts.drop("signature", "set_key"), near["node"] == texts["_rep"]).drop("node")
    members = stage(members.withColumn("_key", F.col("_first.key")).drop("_first"), "members")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_ngrams").alias("total"))
    blocks = F.expr(f"greatest(ceil(n / {how.block_texts}), ceil(total / {how.block_ngrams}))").alias("blocks")
    placed = members.join(sizes.select("component", blocks), "component")
    full = keep_ids(docs.select(row_key(key, text).alias("_key"), F.col(text).alias("_text")), members, "_key")
    # Repeated rows have one key.
    full = full.groupBy("_key").agg(F.first("_text").alias("_text"))
    words = how.words
    full = map_batches(full, lambda batch: _sets(batch, words), "_key binary, ngrams binary")
    units = _blocks(placed.join(full, "_key"), "blocks").groupBy("component", "_i", "_j")
    units = units.agg(F.collect_list(F.struct("_rep", "copies", "_own", "ngrams")).alias("members"))
    threshold = how.threshold

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(_verified(batch, threshold))
        columns = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "label"])

    verified = stage(map_batches(units.filter("size(members) > 1").select("_i", "_j", "members"), verify, "node long, links long, label long"), "verified")
    classes = components(verified, "node", "label").withColumnRenamed("component", "_class")
    summed = verified.groupBy("node").agg(F.sum("links").alias("links")).join(classes, "node", "left")
    linked = texts.join(summed.withColumnRenamed("node", "_rep"), "_rep")
    named = linked.groupBy("_class").agg(F.min("_first").alias("_head"), F.min("set_key").alias("class_key"))
    linked = linked.select("set_key", "links", "_class").join(named, "_class").drop("_class")
    known = texts.select("set_key", "copies", "_first").join(linked.withColumnRenamed("set_key", "_set"), F.col("set_key") == F.col("_set"), "left")
    known = known.select(
        "set_key",
        F.coalesce("_head", "_first").alias("_head"),
        F.coalesce("class_key", "set_key").alias("class_key"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    # A row without n-grams has no class text; a key of its own keeps such rows from meeting in one task.
    lookup = F.when(F.col("n_ngrams") > 0, F.col("set_key")).otherwise(F.col("_key"))
    joined = rows.drop("signature").withColumn("set_key", lookup).join(known, "set_key", "left")
    return joined.select(
        "_id", "_key", "n_ngrams", F.coalesce("_head.id", F.when(F.col("_head").isNull(), F.col("_id"))).alias("class_id"),
        F.hex("class_key").alias("class_key"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("_head").isNull() | (F.col("_head.key") == F.col("_key"))).alias("_stays"),
    )


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Similarity = Similarity()) -> DataFrame:
    """One row per row of docs: (key, class_id, class_key, n_links, n_ngrams).

    class_id is the smallest id of the connected class, n_links the number of
    other rows whose n-gram sets have at least the threshold similarity; both
    follow from exact comparison of the full sets of all candidates.
    """
    return _classified(docs, key, text, how).select(F.col("_id").alias(key), "class_id", "class_key", "n_links", "n_ngrams")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Similarity = Similarity()) -> DataFrame:
    """One row of each class: that with the smallest id (those without one last). Columns are docs' own.

    Of equal rows of a class one stays; rows without n-grams all stay.
    """
    found = stage(_classified(docs, key, text, how).filter("n_links > 0").select("_key", "_stays"), "classes")
    mark = "_key"
    while mark in docs.columns:
        mark += "_"
    found = found.withColumnRenamed("_key", mark)
    first = keep_ids(docs.withColumn(mark, row_key(key, text)), found.filter("not _stays"), mark, keep=False)
    repeated = stage(found.filter("_stays").groupBy(mark).agg(F.count("*").alias("n")).filter("n > 1").select(mark), "repeated")
    if repeated.isEmpty():
        return first.drop(mark)
    once = keep_ids(first, repeated, mark).dropDuplicates([mark])
    return keep_ids(first, repeated, mark, keep=False).unionByName(once).drop(mark)
