"""Columns that a contract fixes, against plain Python over whole documents."""

import hashlib
import re
from collections import Counter

from starloom.llm.queries import QUERIES, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(spark, small):
    return sorted((r.doc_id, r.text or "") for r in table(spark, small, "documents").select("doc_id", "text").collect())


def test_fingerprints_of_edited_texts(spark, small):
    docs = rows(spark, small)
    found = {r.doc_id: r for r in QUERIES["op1_document_fingerprints"](spark, small).collect()}
    assert len(found) == len(docs)
    prints = {}
    for place, (doc_id, text) in enumerate(docs):
        # The next by descending id is the one before; after the smallest id comes the largest.
        other, half = docs[place - 1][1], len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) or text != edited
    assert len(set(prints.values())) == len({tuple(sorted(line for line in t.split("\n") if line.strip())) for t in prints})


def test_quality_counts(spark, small):
    found = {r.doc_id: r for r in QUERIES["op5_quality_rules"](spark, small).collect()}
    for doc_id, text in rows(spark, small):
        words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        r = found[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(words) < 50 or 100 * len(again) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(part) <= 255 for part in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def test_personal_data_of_the_patterns(spark, small):
    found = {r.doc_id: r for r in QUERIES["op2_personal_data"](spark, small).collect()}
    total = Counter()
    for doc_id, text in rows(spark, small):
        spans = {kind: [m.span() for m in re.finditer(pattern, text) if right(m[0])] for kind, (pattern, right) in BASE.items()}
        named = [f"{kind}:{start}:{end}" for kind, own in spans.items() for start, end in own]
        r = found[doc_id]
        assert {kind: r[f"n_{kind}"] for kind in BASE} == {kind: len(own) for kind, own in spans.items()}
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r.spans.split(","))
        total.update({kind: len(own) for kind, own in spans.items()})
    assert total["email"] and total["ip"]
