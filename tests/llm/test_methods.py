"""The operators' methods against brute force, the library, or exact arithmetic."""

import math
import random
import re

import numpy as np
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from starloom.llm import fingerprints, jaccard, licenses, mixing, pieces, pii, rules, scoring, toxicity, warc
from starloom.llm.queries import QUERIES, table
from starloom.llm.tagger import PAD, Tagger
from starloom.llm.textscan import Words


def test_fingerprint_is_a_multiset_hash():
    one, two, three = "a b c d", "e f g", "h i j k l"
    whole = fingerprints.fingerprints([f"{one}\n{two}\n{three}".encode(), f"{three}\n\n{one}\n{two}".encode()])
    assert (whole[0] == whole[1]).all()
    less = fingerprints.delete(whole[0], two)
    assert (less == fingerprints.fingerprints([f"{one}\n{three}".encode()])[0]).all()
    assert (fingerprints.insert(less, two) == whole[0]).all()


def test_tagger_gradients():
    tagger, draw = Tagger(2, hidden=3, seed=1), np.random.default_rng(0)
    codes, mask = draw.integers(0, 100, (3, 7)), np.ones((3, 7), bool)
    mask[1, 5:] = False
    codes[~mask] = PAD
    gold = np.array([[0, 1, 2, 0, 3, 4, 4], [1, 2, 0, 0, 3, 0, 0], [0, 0, 0, 1, 2, 2, 0]])
    _, grads = tagger.step(codes, gold, mask)
    for name, place in (("input", (0, int(codes[0, 2]), 5)), ("again", (1, 2, 3)), ("out", (4, 1)), ("bias", (2,)), ("moves", (1, 2))):
        weights = tagger.weights[name]
        sides = []
        for step in (1e-5, -2e-5):
            weights[place] += step
            sides.append(tagger.step(codes, gold, mask)[0])
        weights[place] += 1e-5
        assert math.isclose(grads[name][place], (sides[0] - sides[1]) / 2e-5, rel_tol=1e-3, abs_tol=1e-7)


def test_patterns_agree_with_plain_expressions():
    draw = random.Random(4)
    for _ in range(3000):
        text = "".join(draw.choices("a1@.-+ 0(25)9", k=draw.randint(0, 40)))
        plain = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        assert pii.emails(text) == plain
        plain = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [(a, b) for kind, a, b in pii.base_spans(text) if kind == "ip"] == plain


def test_spans_are_reconciled():
    found = pii.reconcile({("ip", 0, 5): 1.0, ("card", 3, 9): 1.5, ("phone", 8, 12): 1.0, ("ip", 20, 25): 0.5})
    assert found == [("ip", 0, 5), ("phone", 8, 12), ("ip", 20, 25)]


def test_bilinear_model_is_normalised_and_learns():
    counts = np.array([[0, 90, 10, 0], [80, 0, 20, 0], [50, 50, 0, 0], [60, 40, 0, 0]], float)
    model = scoring.LogBilinear(4, scoring.Scoring(width=4))
    course = model.fit(counts)
    logs = model.log_probabilities()
    assert course[-1] > course[0]
    assert np.allclose(np.exp(logs).sum(1), 1)
    assert logs[0, 1] > logs[0, 0] and logs[1, 0] > logs[1, 1]


def test_scores(spark, small):
    import collections
    import zlib

    rows = table(spark, small, "documents").select("doc_id", "text").collect()
    lower = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    tokens = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(lower)), None] for r in rows}
    counts = collections.Counter()
    for key, own in tokens.items():
        if zlib.crc32(str(key).encode()) % 5 != 1:
            counts.update(own)
    total = sum(counts.values())
    found = scoring.score(table(spark, small, "documents"), how=scoring.Scoring(frequent_words=200, classes=50)).collect()
    assert len(found) == len(rows)
    for r in found:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in tokens[r.doc_id])
        assert (r.n_tokens, r.train_tokens) == (len(tokens[r.doc_id]), total)
        assert r.n_known == sum(counts[w] > 0 for w in tokens[r.doc_id])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_conditional_compression_names_differences():
    _, ready = licenses.prepared(tuple(sorted(licenses.TEMPLATES.items())), 9)
    name, _, agreement, missing, added, _, _ = licenses.compare("this was released under the old mit license today", ready, licenses.Scanning())
    assert (name, agreement, missing, added) == ("MIT", 1.0, [], ["old"])
    assert licenses.compare("released the hounds under the bridge", ready, licenses.Scanning()) is None


def test_binomial_bound_is_exact():
    exact = sum(math.comb(50, k) * 0.1**k * 0.9 ** (50 - k) for k in range(4))
    assert math.isclose(rules.binomial_tail(3, 50, 0.1), exact, rel_tol=1e-12)
    good, bad = [900, 60, 30, 5, 5], [10, 10, 0, 0, 80]
    step, lost, caught = rules.mildest_first(good, bad, 0.05, 0.01, 1.0)
    assert (step, lost, caught) == (4, 5, 80)
    assert rules.mildest_first([20, 0], [0, 20], 0.01, 0.01, 1.0) == (None, 0, 0)


def test_measures():
    assert rules.measure_text("a b c a b c\nx\n\nx\n") == (8, 8, 0, 1, 6, 3, 0, 8, 0)
    assert rules.measure_text("A# 1 é") == (3, 4, 1, 0, 0, 1, 1, 1, 2)


def test_shingles_and_signatures():
    scan = Words([b"a b c d e f", b"", b"x y", b"a b c d e f"])
    hashes, bounds = scan.shingles(5)
    assert bounds.tolist() == [0, 2, 2, 3, 5] and (hashes[:2] == hashes[3:]).all()
    bands, rows = jaccard.choose_bands(0.8, 0.9995, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.9995


def test_links_by_brute_force(spark):
    draw = random.Random(2)
    base = [[f"w{draw.randrange(400)}" for _ in range(60)] for _ in range(4)]
    texts = []
    for k in range(60):
        own = list(base[k % 4])
        for _ in range(k % 5):
            own[draw.randrange(60)] = f"n{draw.randrange(50)}"
        texts.append(" ".join(own))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for t in texts]
    near = [[j for j in range(60) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for how in (jaccard.Similarity(), jaccard.Similarity(block_texts=4, block_ngrams=300)):
        found = {r.doc_id: r for r in jaccard.similar(docs, how=how).collect()}
        assert [found[k].n_links for k in range(60)] == [len(n) for n in near]
        assert all(found[i].class_id == found[j].class_id for i in range(60) for j in near[i])


def test_ordinal_chances_are_ordered():
    rows, places = np.arange(400), np.repeat([0, 1, 2, 3], 100)
    model = toxicity.fit(np.arange(4), rows, places, np.zeros(400), places.copy(), toxicity.Fitting())
    chances = model.chances(model.presence)
    assert (np.diff(model.thresholds) > 0).all() and np.allclose(chances.sum(1), 1)
    assert (chances.argmax(1) == np.arange(4)).all() and (np.diff(chances @ np.arange(4)) > 0).all()


def test_schedule_stays_within_one_block():
    for weights in ({"a": 5, "b": 3, "c": 1}, {"a": 1, "b": 1}, {"x": 97, "y": 2, "z": 0.5, "w": 0.5}):
        whole = mixing.shares(weights, 1000)
        slots, done = mixing.schedule(whole), dict.fromkeys(whole, 0)
        order = sorted((slot, s) for s, own in slots.items() for slot in own)
        assert [slot for slot, _ in order] == list(range(1000))
        for slot, source in order:
            done[source] += 1
            assert all(abs(done[s] - whole[s] * (slot + 1) / 1000) < 1 for s in whole)


def test_one_record_by_its_index(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"u{k}", f"page {k} " * 40) for k in range(300)], "page_id long, url string, html string")
    target = f"file://{tmp_path}"
    index = warc.write_bundles(pages, target, how=warc.Bundling(bundle_bytes=20_000, frame_bytes=2_000)).collect()
    assert len(index) == 300 and len({r.bundle for r in index}) > 1
    for r in index[::37]:
        head, body = warc.read_record(target, r.bundle, r.frame, r.offset, r.length)
        assert (int(head["WARC-Page-ID"]), body.decode()) == (r.page_id, f"page {r.page_id} " * 40)


def test_pieces_agree_with_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, draw = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(1)
    with open(path, "rb") as file:
        own = pieces.Pieces(file.read())
    for letters in (" \n\tabÉ中😀0.  <s>|#\r", " ▁a\n"):
        texts = ["", " ", "  a", "a\n\n b", *("".join(draw.choices(letters, k=draw.randint(1, 30))) for _ in range(500))]
        want, found = library.encode(texts), own.encode(texts)
        assert [i.tolist() for i in found.ids] == want
        assert [d.decode() for d in found.decoded] == library.decode(want)
        for text, ids, widths in zip(texts, want, found.widths, strict=True):
            assert widths.sum() == len(text.encode()) and np.cumsum(widths).tolist() == own.spans(text, ids)[:, 1].tolist()


def test_character_map_agrees_with_the_library():
    draw = random.Random(1)
    for rule in ("nmt_nfkc", "nfkc_cf"):
        library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(library.serialized_model_proto())
        spec = proto.normalizer_spec
        own = pieces.Normaliser(pieces.CharMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        for _ in range(500):
            text = "".join(draw.choices("aAÅé①ﬁ㍿  ａ　\t\nガｶﾞ½İßx", k=draw.randint(0, 12)))
            normal, source = own(text)
            assert normal.decode() == library.normalize(text) and len(source) == len(normal) + 1


def test_every_query_covers_its_table(spark, small):
    for name in ("op5_quality_rules", "op8_mixing", "op10_sentencepiece"):
        assert QUERIES[name](spark, small).count() == table(spark, small, "documents").count()
    assert QUERIES["op9_warc"](spark, small).count() == table(spark, small, "pages").count()
