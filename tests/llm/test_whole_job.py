"""Cases that only a whole job gets right: many words, many periods, many notices."""

import random

import numpy as np

import corpus_pipeline
from starloom.llm import licenses, mixing, scoring, warc
from starloom.llm.textscan import Words


def test_every_counted_word_is_modelled(spark):
    # No word but the endings repeats often: -ka is followed by -lo, -lo by -ka.
    draw = random.Random(3)
    texts = []
    for _ in range(400):
        stems = ["".join(draw.choices("bcdfgmnprst", k=6)) for _ in range(40)]
        texts.append(" ".join(stem + ("ka", "lo")[k % 2] for k, stem in enumerate(stems)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = scoring.score(docs, how=scoring.Scoring(classes=4)).collect()
    held = [r for r in found if r.held_out]
    # The ending of the next word is known from that before, and whether the text ends there is not.
    assert sum(r.score - r.base_score for r in held) > 0.2 * sum(r.n_tokens for r in held)


def test_word_classes_add_up_to_one(spark):
    words = [f"{a}{b}{c}" for a in "abcdef" for b in ("ing", "tion", "es", "o") for c in ("", "!", "?")]
    text = " ".join(w for k, w in enumerate(words) for _ in range(k % 5 + 1))
    docs = spark.createDataFrame([(0, text)], "doc_id long, _text string")
    counts = scoring.word_counts(docs).cache()
    scan = Words([text.encode()], lower=True)
    top = np.unique(scan.hashes.view(np.int64))[:3]
    classes = scoring.choose_classes(counts, top, 8)
    rows = counts.filter(f"word <> {scoring.END}").toArrow()
    places = classes(rows.column("word").to_numpy(), rows.column("ending").to_numpy())
    assert len(places) == len(words) and (places < classes.size).all() and len(set(places)) > len(top) + 4
    assert (classes(scan.hashes.view(np.int64), scoring.endings_of(scan)) < classes.size).all()
    masses, shares = scoring.class_masses(counts, classes), np.full(classes.size, 0.5)
    np.add.at(shares, places, rows.column("n").to_numpy() + 0.5)
    assert np.allclose(shares, masses)


def test_tokens_keep_their_place_in_the_mix(spark, tmp_path):
    rows = [(k, f"text number {k}", "ab"[k % 10 == 0]) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = corpus_pipeline.source_mix(spark, docs, "")
    want = {r.doc_id: r.position for r in mixing.mix(docs, mixing.natural_weights(docs, "source")).collect()}
    # Written and read again in an order of the reader's own, as between the stages.
    mixed.write.parquet(f"{tmp_path}/mixed")
    read = spark.read.parquet(f"{tmp_path}/mixed").orderBy("doc_id")
    found = corpus_pipeline.sentencepiece_tokens(spark, read, "").collect()
    assert {r.doc_id: r.mix_position for r in found} == want and len(set(want.values())) == 400
    assert all(r.source == "ab"[r.doc_id % 10 == 0] and r.n_tokens == len(r.ids) for r in found)


def test_no_source_falls_behind_its_exact_weight():
    # A third of all rows on one source, root weights: no period of 10,000 slots holds these shares in whole slots.
    counts = {"big": 6_000_000, **{f"s{k:02d}": 600_000 + 7 * k for k in range(19)}}
    weights = {s: n**0.5 for s, n in counts.items()}
    whole, total = mixing.whole_weights(weights), sum(weights.values())
    done, end = dict.fromkeys(counts, 0), 400_000
    for slot, source, k in mixing.slots_of(whole, dict.fromkeys(counts, 10**9)):
        if slot == end:
            break
        assert k == done[source]
        done[source] += 1
        if slot % 997 == 0 or slot > end - 50:
            assert all(abs(done[s] - weights[s] / total * (slot + 1)) < 1 + 1e-6 for s in done)
    assert slot == end == sum(done.values())


def test_mix_follows_the_exact_weights(spark):
    rows = [(k, "a") for k in range(40)] + [(k, "b") for k in range(40, 3040)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"a": 1.0, "b": 99_999.0}
    how = mixing.Mixing(block_rows=1, run_blocks=64, portion=500)
    found = mixing.mix(docs, weights, how=how).collect()
    assert len(found) == 3040 and {r.source: r.share for r in found} == {"a": 1e-5, "b": 0.99999}
    slots = {(r.source, r.block): r.slot for r in found}
    assert len(set(slots.values())) == len(slots) == 3040
    for (source, k), slot in slots.items():
        assert k * 100_000 // weights[source] <= slot < -(-(k + 1) * 100_000 // weights[source])


def test_any_number_of_sources_is_mixed(spark):
    docs = spark.range(6_000).selectExpr("id as doc_id", "concat('site', id % 2500) as source")
    found = mixing.mix(docs, mixing.natural_weights(docs, "source")).collect()
    assert sorted(r.doc_id for r in found) == list(range(6_000))
    assert len({r.source for r in found}) == len({r.slot for r in found}) == 2_500


def test_every_notice_of_a_block_is_found(spark):
    apache, mit, by = (licenses.TEMPLATES[n] for n in ("Apache-2.0", "MIT", "CC-BY-4.0"))
    gpl, lgpl, mpl = (licenses.TEMPLATES[n] for n in ("GPL-3.0", "LGPL-3.0", "MPL-2.0"))
    texts = {
        f"{apache} {mit}": ["Apache-2.0", "MIT"],
        f"see {mit}\n{mit} thanks": ["MIT", "MIT"],
        f"{apache} {gpl} {mit} {by} {lgpl} {mpl} {mit}": ["Apache-2.0", "GPL-3.0", "MIT", "CC-BY-4.0", "LGPL-3.0", "MPL-2.0", "MIT"],
        "hounds run under the mit bridge": [],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.find_licenses(docs).orderBy("doc_id", "start").collect()
    for k, (text, want) in enumerate(texts.items()):
        own = [r for r in rows if r.doc_id == k]
        assert [r.license for r in own] == want
        assert all(text[r.start : r.end] == r.wording for r in own)
        assert all(a.end <= b.start for a, b in zip(own, own[1:]))


def test_reserved_rights_and_changed_words_are_found(spark):
    texts = ["x\nAll rights reserved.\ny", "Released under an MIT license", "of the rights all reserved", licenses.TEMPLATES["ISC-notice"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.license) for r in licenses.find_licenses(docs).collect()}
    assert found == {(0, "All-rights-reserved"), (1, "MIT"), (3, "ISC-notice")}


def test_offsets_of_notices_behind_letters_that_grow_in_lower_case():
    text = "\u0130\u0130\u0130 Released under the MIT License. ok"
    _, ready = licenses.prepared(tuple(sorted(licenses.TEMPLATES.items())), 3)
    found = licenses.compare_all(text, ready, licenses.Scanning())
    assert [text[f[5] : f[6]] for f in found] == ["Released under the MIT License"]


def test_bundles_are_read_back_by_several_tasks(spark, tmp_path):
    rows = [(k, f"http://a.example/{k}", f"<p>{k}</p>" * 300) for k in range(400)]
    pages = spark.createDataFrame([(*row, "x", 1) for row in rows], "page_id long, url string, html string, bundle string, frame int")
    folder = f"file://{tmp_path}/w"
    how = warc.Bundling(bundle_bytes=200_000, frame_bytes=20_000)
    index = warc.write_bundles(pages, folder, how=how)
    bundles = index.select("bundle").distinct().count()
    back = warc.read_bundles(spark, folder, index)
    assert bundles >= 4 and back.rdd.getNumPartitions() >= 4
    assert len({r.task for r in back.selectExpr("spark_partition_id() as task").distinct().collect()}) > 1
    assert sorted((r.page_id, r.payload.decode()) for r in back.collect()) == [(k, h) for k, _, h in rows]
    # A second run into the same folder replaces the files.
    again = warc.read_bundles(spark, folder, warc.write_bundles(pages, folder, how=how))
    assert again.count() == 400
    entry = index.filter("page_id = 7").first()
    head, body = warc.read_record(folder, entry.bundle, entry.frame, entry.offset, entry.length)
    assert head["WARC-Date"].endswith("Z") and body.decode() == rows[7][2]
