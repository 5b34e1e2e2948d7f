"""Periodic runs, main texts of pages and conversation repair against brute force, and over odd input."""

import hashlib
import html
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import groupby

import pytest

from starloom.llm import conversations, dom, queries, runs, wrappers
from starloom.llm.runs import Periodic

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, how=Periodic()):
    """Every maximal stretch of each period, by comparison of words, if no smaller period fits."""
    found, n = [], len(words)
    for q in range(1, n // how.exponent + 1):
        i = 0
        while i + q < n:
            first = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - first
            if i > first and size >= max(how.words, how.exponent * q):
                part = words[first : first + size]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((first, size, q))
            i = max(i, first + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("how", [Periodic(), Periodic(2, 2), Periodic(3, 3)])
def test_runs_of_random_words(how):
    draw = random.Random(1)
    for _ in range(1500):
        words = [draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(draw.randrange(60))]
        if words and draw.random() < 0.5:
            at, period = draw.randrange(len(words)), draw.randrange(1, 6)
            words[at:at] = (words[at : at + period] * 40)[: draw.randrange(40)]
        assert runs.find_runs(words, how) == plain_runs(words, how)


def test_run_digests_of_documents(spark):
    docs = queries.table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = queries.op11_periodic_runs(spark, SMALL).collect()
    assert len(found) == len(texts) and sum(r.n_runs > 0 for r in found) > 10
    for row in found:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (texts[row.doc_id] or "").encode())
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want = plain_runs(words)
        gone = {k for start, size, period in want for k in range(start + period, start + size)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        best = max(want, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(want), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert row.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % run for run in want).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()


def test_runs_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a " * 9), (4, "a a " * 6), (4, "a a " * 6), (5, "x y " * 30_000), (6, "a b a b a b a")]
    docs = spark.createDataFrame([(i, t, 7, "z") for i, t in rows], "doc_id long, text string, runs int, _text string")
    found = [(r.doc_id, [tuple(x) for x in r.runs]) for r in runs.document_runs(docs).collect()]
    want = [(1, []), (2, []), (3, []), (None, [(0, 9, 1)]), (4, [(0, 6, 1)]), (4, [(0, 6, 1)]), (5, [(0, 60_000, 2)]), (6, [])]
    assert sorted(found, key=str) == sorted(want, key=str)
    digests = runs.run_digests(docs, rewrite=runs.repeat_tail).filter("doc_id in (1, 2, 3)").collect()
    assert {(r.n_runs, r.start, r.collapsed_sha256) for r in digests} == {(0, None, hashlib.sha256(b"").hexdigest())}
    assert runs.run_digests(docs.limit(0)).count() == 0


@lru_cache(None)
def cheapest(turns, state=0, inserted=0):
    """(cost, letters) by trying every edit."""
    found = [(0, "")] if not turns and state in (0, 3) else []
    filled = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    options = [("I", 2, turns, filled)] if inserted < 4 else []
    if turns:
        (initial, fault), rest = turns[0], turns[1:]
        options.append(("D", 3, rest, state))
        if fault != conversations.DELETE:
            late = int(fault == conversations.TRUNCATED)
            options.append(("R", 2 + late, rest, filled))
            if (initial, state) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
                options.append(("K", late, rest, {"s": 1, "u": 2, "a": 3}[initial]))
    for letter, cost, left, to in options:
        rest = cheapest(left, to, inserted + 1 if letter == "I" else 0)
        if rest:
            found.append((cost + rest[0], letter + rest[1]))
    return min(found, default=None)


def test_cheapest_edits_of_random_conversations():
    draw = random.Random(5)
    kinds = [(i, f) for i in ("s", "u", "a", "") for f in ("", conversations.TRUNCATED)] + [("", conversations.DELETE)]
    for _ in range(1500):
        turns = [t for t in draw.choices(kinds, k=draw.randrange(9)) for _ in range(draw.choice([1, 1, 2, 5]))]
        collapsed = [(t, len(list(g))) for t, g in groupby(turns)]
        assert conversations.cheapest_edits(collapsed) == cheapest(tuple(turns))


def plain_audit(conv, turns):
    """A conversation's row and repaired lines, turn by turn."""
    out = []
    for turn, role, text in turns:
        role, text = role if role is not None else " ", text if text is not None else " "
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        out += [] if drawn == 0 else [(turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, counts, marks = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, role, text in out:
        ends = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not ends else "duplicate" if (role, text) in seen else "" if ends[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marks.append(conversations.symbol(role, fault))
    known = {t for t, _, _ in out if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    cost, letters = cheapest(tuple(marks))
    lines, left, state = [], iter(out), 0
    for letter in letters:
        _, role, text = (None, None, "") if letter == "I" else next(left)
        if letter == "D":
            continue
        state = {"s": 1, "u": 2, "a": 3}[role[0]] if letter == "K" else {0: 2, 1: 2, 2: 3, 3: 2}[state]
        lines.append((role if letter == "K" else {2: "user", 3: "assistant"}[state], text))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, *counts.values(), illegal, cost, letters, digest), lines


def check_conversations(table):
    whole = defaultdict(list)
    for row in table.collect():
        whole[row.conv_id].append((row.turn, row.role, row.text))
    damaged = conversations.damage(table)
    found = {r.conv_id: tuple(r[name] for name in (*conversations.AUDIT, "audit", "repaired_sha256")) for r in conversations.audit(damaged).collect()}
    repaired = defaultdict(list)
    for row in sorted(conversations.repair(damaged).collect(), key=lambda r: (str(r.conv_id), r.position)):
        repaired[row.conv_id].append((row.role, row.text))
    assert found.keys() == whole.keys()
    for conv, turns in whole.items():
        want, lines = plain_audit(conv, turns)
        assert found[conv] == want and repaired[conv] == lines
    return found


def test_audits_of_conversations(spark):
    found = check_conversations(queries.table(spark, SMALL, "conversations"))
    assert len({row[-2] for row in found.values()}) > 5


def test_odd_conversations(spark):
    draw = random.Random(2)
    said = ["", " ", "yes.", "no", "yes.", "why?", " ", "x" * 50_000 + "!"]
    rows = [(conv, draw.choice([None, 0, 1, 2, 7]), draw.choice([None, "user", "assistant", "system", "tool", ""]), draw.choice([None, *said])) for conv in (None, 1, 2, 3, 4) for _ in range(12)]
    # Every turn of conversation 9 is lost: each has a checksum divisible by 20.
    lost = [t for t in range(400) if zlib.crc32(f"9:{t}".encode()) % 20 == 0]
    rows += [(9, t, "user", "hello.") for t in lost]
    table = spark.createDataFrame([(*row, "z", 1) for row in rows], "conv_id long, turn long, role string, text string, _text string, cost int")
    found = check_conversations(table)
    assert found[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.audit(conversations.damage(table.limit(0))).count() == 0
    assert conversations.repair(conversations.as_turns(table.limit(0))).count() == 0


def test_a_long_conversation_of_one_role():
    cost, letters = conversations.cheapest_edits([(("u", ""), 100_001)])
    assert cost == 2 * 50_001 - 0 and len(letters) >= 100_001


def plain_article(page):
    """The blocks of a page of the test tables, whose article is one element of headings and paragraphs."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_main_texts_of_pages(spark):
    pages = {r.page_id: r for r in queries.table(spark, SMALL, "pages").collect()}
    found = queries.op12_html_extraction(spark, SMALL).collect()
    assert len(found) == len(pages)
    for row in found:
        want = plain_article(pages[row.page_id].html)
        assert (row.url, row.text, row.n_chars) == (pages[row.page_id].url, want, len(want))


def unnamed_page(draw, k, story):
    """A page that says nothing by its tags or names: what is template shows only beside other pages."""
    extra = "<div>Reload for the latest results</div>" if k % 2 else ""
    words = "".join(f"<p>{p}</p>" for p in story)
    return (
        f"<html><body><div><div>Daily Post</div><div>Politics Sports Weather</div></div>{extra}<div>"
        f"{words}<p>Call our office to report a mistake</p></div><div>All rights reserved to us</div></body></html>"
    )


@pytest.mark.parametrize("how", [wrappers.Induction(), wrappers.Induction(samples=2, broadcast_bytes=0, open_hosts=1)])
def test_templates_without_names(spark, how):
    draw = random.Random(4)
    stories = {k: [" ".join(draw.choices("sun moon rain wind hail fog".split(), k=12)) + f" {k} {j}" for j in range(draw.randrange(2, 6))] for k in range(40)}
    # Copies and near copies of one story on the same host keep their text.
    for k in range(30, 40):
        stories[k] = [*stories[30][:2], f"own ending number {k}"]
    rows = [(k, f"http://Paper.example/{k}", unnamed_page(draw, k, story)) for k, story in stories.items()]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in wrappers.extract(table, how=how).collect()}
    assert found == {k: "\n\n".join(story) for k, story in stories.items()}


def test_what_is_no_article_goes():
    page = """<html><head><title>T</title><meta name=x><body class="menu"><header><h1>Site</h1></header><nav>Menu</nav>
    <div id="cookie-notice">We use cookies</div><main><article><header><h1>Head&shy;line</h1></header><p>One &amp; two<p>three
    <a href=x>four</a>, <b>five<br>six<ul><li>a<li>b</ul><span class="sponsored">buy</span><aside>side</aside><form>f</form>
    <script>if (a < b) "</p>"</script><style>p{}</style><!-- <p>no</p> --><div class="share-buttons">Share</div><p hidden>h</p>
    <table><tr><td>5 < 6<td>y</table><section class="commentsList"><p>Great!</p></section></article></main><footer>End</footer>"""
    blocks = wrappers.content(dom.parse(page), None, set(), 0)
    assert blocks == ["Head­line", "One & two", "three four, five six", "a", "b", "5 < 6", "y"]


@pytest.mark.parametrize("page", ["", "<", "<p", "</p>", "<!--", "<" * 50, '<a "' * 2000, "<div>" * 3000 + "x", "</div>" * 5, "<p>" * 3000 + "y", "<script>x", "a > b"])
def test_broken_pages_have_a_text(page):
    tree = dom.parse(page)
    dom.Matching().align(tree, dom.parse("<div><p>q</p></div>"))
    want = {"<": "<", "<p": "<p", "<" * 50: "<" * 50, "<div>" * 3000 + "x": "x", "<p>" * 3000 + "y": "y", "a > b": "a > b"}
    if '"' not in page:
        assert "\n\n".join(wrappers.content(tree, None, set(), 0)) == want.get(page, "")


def test_long_lists_are_aligned_in_halves():
    draw = random.Random(6)
    left = ["".join(draw.choices("ab", k=3)) for _ in range(1300)]
    right = [w for w in left if draw.random() < 0.8] + ["zz"] * 90
    trees = [dom.parse("<article>" + "".join(f"<p>{w}</p>" for w in words)) for words in (left, right)]
    matched = dom.Matching().align(*trees)
    places = [matched[n.place].place for n in trees[0].walk() if n.place in matched]
    assert places == sorted(places) and len(set(places)) == len(places)
    equal = sum(n.mark == matched[n.place].mark != 0 for n in trees[0].walk() if n.place in matched)
    assert equal >= len(right) - 90


def test_odd_pages(spark):
    page = "<p>one</p><p>two</p>"
    rows = [(1, None, None), (2, "", ""), (3, "http:///x", page), (None, "http://a.b/", page), (4, "http://a.b/1", page), (4, "http://a.b/1", page), (5, "http://a.b:80/2", None), (6, "nonsense", "x " * 100_000)]
    table = spark.createDataFrame([(*row, "q", 1, "t") for row in rows], "page_id long, url string, html string, text string, n_chars int, template string")
    found = [(r.page_id, r.url, r.text) for r in wrappers.extract(table).collect()]
    want = [(i, u, {None: "", "": "", page: "one\n\ntwo"}.get(h, ("x " * 100_000).strip())) for i, u, h in rows]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert wrappers.extract(table.limit(0)).count() == 0
