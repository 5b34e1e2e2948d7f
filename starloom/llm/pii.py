"""Personal data: fixed patterns, and spans that a trained tagger adds.

The patterns find e-mail addresses, IP addresses, card numbers with a valid
check digit and phone numbers; their spans always stay. A character-level
bidirectional LSTM with CRF transitions (tagger.py) is trained in the driver on
windows around labelled spans of a bounded sample of documents, some of them
rewritten in other usual forms, and around other digits, which are labelled
outside. It is then applied to all texts.

Every span of these kinds holds a digit of some script, an at sign, or the word
"at" in brackets or before a spelled "dot". So windows are laid over every
stretch of whole words that comes near such a place, and the rest of a text,
where nothing could be tagged, is not decoded. Windows overlap by half. Spans
that touch a cut inside a stretch are left to the window that sees them whole,
and the spans of all windows of a text are reconciled at once: of overlapping
ones the set of highest total score is kept (weighted interval scheduling). An
exact check follows, wider than the patterns: digits of any script and any
separators, spelled at and dot, letters of any script; but an added card number
needs a valid check digit, an address four small parts, a phone number a plus
sign or groups.

Edge cases: a null text is empty; without labelled spans in the sample the
tagger learns from generated ones alone; equal texts have equal spans.
"""

from __future__ import annotations

import bisect
import hashlib
import pickle
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import map_batches, texts_of
from starloom.llm.tagger import PAD, Tagger, symbols

KINDS = ("email", "ip", "card", "phone")
OTHER_ZEROS = (0x0660, 0x0966, 0xFF10)  # Arabic-Indic, Devanagari and full-width digits
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match always takes whole digit runs, so starting only at their first digit and never giving one back changes nothing.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"\d|[@\uff20]|[\[({<]\s?at\s?[\])}>]|\sat\s(?=\S+(?:\s\S+)?\sdot\s)", re.IGNORECASE)
AT = r"(?:\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s|\s?[@\uff20]\s?)"
DOT = r"(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s|[.\uff0e\u3002])"
NAME = r"[^\W_](?:[\w%+-]*[^\W_])?"
ANY_EMAIL = re.compile(rf"{NAME}(?:{DOT}{NAME})*{AT}{NAME}(?:{DOT}{NAME})+", re.IGNORECASE)
ANY_ADDRESS = re.compile(rf"(\d+){DOT}(\d+){DOT}(\d+){DOT}(\d+)", re.IGNORECASE)
ANY_PHONE = re.compile(r"\+?[(]?\d+(?:[^\w\n,;:]{1,3}\d+)*")
DAY = re.compile(r"\d{4}(\D)\d\d?\1\d\d?|\d\d?(\D)\d\d?\2\d{4}")

Span = tuple[str, int, int]


@dataclass(frozen=True)
class Training:
    """The bounds of what the tagger learns from."""

    sample_documents: int = 1_500
    sample_chars: int = 4_000  # of one document
    windows: int = 2_400
    epochs: int = 8
    window: int = 96
    reach: int = 24
    # An added span needs at least this probability at its least sure character.
    sure: float = 0.5
    seed: int = 11


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping addresses, found from each @: all that stands before it belongs to the name."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            found.append((start, free))
        at = text.find("@", free)
    return found


def small_parts(address: str) -> bool:
    """No part above 255; a part may have any number of leading zeros."""
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in address.split(".")))


def base_spans(text: str) -> list[Span]:
    """The patterns' spans by kind, then start."""
    if not HINT.search(text):
        return []
    spans = [("email", a, b) for a, b in emails(text)]
    spans += [("ip", m.start(), m.end()) for m in ADDRESS.finditer(text) if small_parts(m[0])]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def windows_of(text: str, size: int, reach: int) -> list[tuple[int, int, bool, bool]]:
    """Overlapping windows over every stretch within reach of a hint, and whether they begin and end the stretch.

    A stretch is widened to whole words, by at most its reach again.
    """
    stretches: list[list[int]] = []
    for m in HINT.finditer(text):
        start, end = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if stretches and start <= stretches[-1][1] + reach:
            stretches[-1][1] = end
        else:
            stretches.append([start, end])
    found = []
    for start, end in stretches:
        least, most = max(0, start - reach), min(len(text), end + reach)
        while start > least and not text[start - 1].isspace():
            start -= 1
        while end < most and not text[end].isspace():
            end += 1
        at = start
        while at + size < end:
            found.append((at, at + size, at == start, False))
            at += size // 2
        found.append((at, end, at == start, True))
    return found


def pad(rows: list[np.ndarray], size: int, fill: int) -> np.ndarray:
    out = np.full((len(rows), size), fill, np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def reconcile(spans: dict[Span, float]) -> list[Span]:
    """The non-overlapping spans of highest total score."""
    order = sorted(spans, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in order]
    totals: list[tuple[float, int, bool]] = [(0.0, 0, False)]
    for k, span in enumerate(order):
        before = bisect.bisect_right(ends, span[1], 0, k)
        with_it = totals[before][0] + spans[span]
        totals.append((with_it, before, True) if with_it > totals[k][0] else (totals[k][0], k, False))
    chosen, k = [], len(order)
    while k:
        _, before, taken_here = totals[k]
        if taken_here:
            chosen.append(order[k - 1])
        k = before
    return chosen[::-1]


def plausible(kind: str, text: str) -> bool:
    """The exact check of a tagged span: what no model of characters can count."""
    digits = "".join(str(int(c)) for c in text if c.isdecimal())
    if kind == "email":
        return ANY_EMAIL.fullmatch(text) is not None
    if kind == "ip":
        parts = ANY_ADDRESS.fullmatch(text)
        return parts is not None and all(len(part) <= 3 and int(part) <= 255 for part in parts.groups())
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    grouped = text.startswith("+") or len(digits) < len(text)
    return 7 <= len(digits) <= 15 and grouped and ANY_PHONE.fullmatch(text) is not None and not DAY.fullmatch(text)


def model_spans(tagger: Tagger, texts: list[str], how: Training) -> list[list[Span]]:
    """The tagger's spans of each text, reconciled over all its windows."""
    places = [(k, *place) for k, text in enumerate(texts) for place in windows_of(text, how.window, how.reach)]
    found: list[dict[Span, float]] = [{} for _ in texts]
    for first in range(0, len(places), 512):
        some = places[first : first + 512]
        codes = pad([symbols(texts[k][a:b]) for k, a, b, _, _ in some], how.window, PAD)
        path, chance = tagger.decode(codes, codes != PAD)
        for row, (k, a, b, begins, closes) in enumerate(some):
            if not path[row].any():
                continue
            tags, at = path[row, : b - a], 0
            while at < len(tags):
                if tags[at] == 0:
                    at += 1
                    continue
                end = at + 1
                while end < len(tags) and tags[end] == tags[at] + 1 and tags[at] % 2 == 1:
                    end += 1
                whole = (at > 0 or begins) and (end < len(tags) or closes)
                text, least = texts[k][a + at : a + end], float(chance[row, at:end].min())
                kind = KINDS[(int(tags[at]) - 1) // 2]
                if whole and least >= how.sure and plausible(kind, text):
                    span = (kind, a + at, a + end)
                    found[k][span] = max(found[k].get(span, 0.0), least * (end - at))
                at = end
    return [reconcile(own) for own in found]


def join_spans(base: list[Span], added: list[Span]) -> list[Span]:
    """All base spans and those added ones that overlap none of them, by kind, then start."""
    busy = sorted((a, b) for _, a, b in base)
    free = []
    for span in added:
        k = bisect.bisect_left(busy, (span[2],))
        if not any(b > span[1] for _, b in busy[max(0, k - len(KINDS)) : k]):
            free.append(span)
    return sorted([*base, *free], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# Training ---------------------------------------------------------------------


def _digits(draw: random.Random, n: int) -> str:
    return "".join(draw.choices("0123456789", k=n))


def other_forms(draw: random.Random, kind: str) -> list[str]:
    """Values of a kind in usual forms that the tagger learns from."""
    if kind == "email":
        word, own, third = ("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 10))) for _ in range(3))
        name = draw.choice((word, word + _digits(draw, 2), _digits(draw, 2) + word, f"{word}.{third}", f"{word}_{_digits(draw, 1)}"))
        accent = draw.choice(("", "", "ä", "ö", "ü", "é", "ñ")) if draw.random() < 0.6 else ""
        host = draw.choice((own, own + accent, own + accent + third, f"{own}5", f"{own}-{third}"))
        end = draw.choice(("com", "org", "net", "de", "info"))
        lower = draw.choice((str.lower, str.upper))
        at, dot = lower("at"), lower("dot")
        return [
            f"{name}@{host}.{end}", f"{name}@{host}.co.uk", f"{name} ({at}) {host}.{end}", f"{name}[{at}]{host}.{end}",
            f"{name} [{at}] {host} [{dot}] {end}", f"{name} {at} {host} {dot} {end}", f"{name}({at}){host}({dot}){end}", f"{name} @ {host}.{end}",
        ]
    if kind == "ip":
        parts = [str(draw.randint(0, 255)) for _ in range(4)]
        return [".".join(parts), "[.]".join(parts), f"{'.'.join(parts[:3])}[.]{parts[3]}", " dot ".join(parts)]
    if kind == "card":
        groups = [_digits(draw, 4) for _ in range(4)]
        return ["".join(groups), " ".join(groups), "-".join(groups), ".".join(groups), f"{groups[0]} {groups[1]}{groups[2][:2]} {groups[2][2:]}{groups[3][:3]}"]
    area, near, far, two = _digits(draw, 3), _digits(draw, 3), _digits(draw, 4), _digits(draw, 2)
    return [
        f"+1 ({area}) {near}-{far}", f"+1 {area} {near} {far}", f"({area}) {near}-{far}", f"{area}-{near}-{far}", f"{area}.{near}.{far}",
        f"+{two} {two} {near} {far}", f"+{two}.{area}.{near}.{far}", f"0{two} {far} {far}", f"{near}-{far}",
    ]


def _other_form(draw: random.Random, kind: str, shown: str) -> str:
    """The span as found, or a generated one in another usual form, some in digits of another script."""
    if shown and draw.random() < 0.3:
        return shown
    value = draw.choice(other_forms(draw, kind))
    if draw.random() < 0.08:
        zero = draw.choice(OTHER_ZEROS)
        value = "".join(chr(zero + int(c)) if "0" <= c <= "9" else c for c in value)
    return value


def _no_span(draw: random.Random) -> str:
    """Digits, dates, times, amounts and words around at, in which nothing is personal."""
    d = lambda n: _digits(draw, n)
    return draw.choice((
        d(draw.randint(1, 5)), f"{d(1)}.{d(1)}", f"{d(2)}:{d(2)}", hashlib.sha1(d(6).encode()).hexdigest(), f"20{d(2)}-0{d(1)}-1{d(1)}",
        f"1{d(1)}/0{d(1)}/20{d(2)}", f"20{d(2)}-0{d(1)}-1{d(1)}T{d(2)}:{d(2)}:{d(2)}", f"19{d(2)}-20{d(2)}", f"${d(2)},{d(3)}.{d(2)}", f"{d(1)}.{d(1)}.{d(2)}",
        d(draw.randint(6, 12)), f"978-0-{d(3)}-{d(5)}-{d(1)}", f"{d(2)}%", f"{d(3)} {d(3)} people", f"({d(2)})", "meet at noon", f"at {d(1)} pm", "look at the dot on",
    ))


def _examples(texts: list[str], how: Training) -> list[tuple[str, list[Span]]]:
    """Windows with their labelled spans: around base spans, around other digits, and generated ones."""
    draw, found, others = random.Random(how.seed), [], []
    for text in texts:
        base = base_spans(text)
        for kind, a, b in base:
            # Another match nearby that the patterns dropped has no sure label.
            before, after = text[max(0, a - how.reach) : a], text[b : b + how.reach]
            if not HINT.search(before + after):
                found.append((kind, before, text[a:b], after))
        for a, b, _, _ in windows_of(text, how.window, how.reach):
            piece = text[a:b]
            if not any(s < b and e > a for _, s, e in base) and not CARD.search(piece) and not ADDRESS.search(piece):
                others.append(piece)
    draw.shuffle(found)
    draw.shuffle(others)
    words = " ".join(texts[:50]).split()[:5_000] or ["a", "the", "of"]
    made = []
    for k in range(how.windows):
        if k % 5 == 4 and others:
            made.append((others[k % len(others)][: how.window], []))
            continue
        if k % 5 == 3:
            made.append((f"{draw.choice(words)[:20]} {_no_span(draw)} {draw.choice(words)[:20]}"[: how.window], []))
            continue
        kind = draw.choice((*KINDS, "email"))  # addresses vary most
        own = [f for f in found[k % 7 :: 7] if f[0] == kind] or [f for f in found if f[0] == kind]
        if own:
            _, before, shown, after = own[draw.randrange(len(own))]
        else:
            before, shown, after = f"{draw.choice(words)[:20]} ", "", f" {draw.choice(words)[:20]}"
        value = _other_form(draw, kind, shown)
        before = before[-draw.randint(0, how.reach) :] if draw.random() < 0.3 else before
        piece = (before + value + after)[: how.window]
        if len(before) + len(value) <= len(piece):
            made.append((piece, [(kind, len(before), len(before) + len(value))]))
    return made


def train(texts: list[str], how: Training = Training()) -> Tagger:
    """A tagger from the labelled spans of the texts."""
    examples = _examples(texts, how)
    codes = pad([symbols(piece) for piece, _ in examples], how.window, PAD)
    gold = np.zeros_like(codes)
    for row, (_, spans) in enumerate(examples):
        for kind, a, b in spans:
            tag = 1 + 2 * KINDS.index(kind)
            gold[row, a], gold[row, a + 1 : b] = tag, tag + 1
    tagger = Tagger(len(KINDS))
    tagger.fit(codes, gold, codes != PAD, how.epochs)
    return tagger


def sample_texts(docs: DataFrame, key: str, text: str, how: Training) -> list[str]:
    """A bounded sample of texts with digits or an @, by a hash of key and text: about how.sample_documents, at most twice that.

    The texts are counted first, so that each task sends its share of the sample only.
    """
    near = docs.select(F.col(text).alias("_text"), (F.xxhash64(F.col(key), F.col(text)) / 2.0**64 + 0.5).alias("_draw"))
    placed = near.withColumn("_at", F.regexp_instr("_text", F.lit("[0-9@]"))).filter("_at > 0")
    share = how.sample_documents / max(1, placed.count())
    # Of a long text, what lies around its first digit or @.
    around = F.expr(f"substring(_text, greatest(_at - {how.sample_chars // 2}, 1), {how.sample_chars})").alias("_around")
    chosen = placed.filter(F.col("_draw") < share).select(around).limit(2 * how.sample_documents).collect()
    return sorted(r["_around"] for r in chosen)


@lru_cache(maxsize=1)
def _restore(weights: bytes) -> Tagger:
    return Tagger(len(KINDS), weights=pickle.loads(weights))


def find_personal_data(docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", how: Training = Training()) -> DataFrame:
    """docs' columns in keep, _text with every span replaced by its kind in angle brackets, _base and _spans as written().

    The tagger's weights, some 80 kB whatever the input, go along with the task.
    """
    weights = pickle.dumps({k: w.astype(np.float32) for k, w in train(sample_texts(docs, key, text, how), how).weights.items()})
    own = {name: f"c{k}" for k, name in enumerate(keep)}
    source = docs.select(*[F.col(name).alias(short) for name, short in own.items()], F.col(text).alias("_text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch, "_text")
        base = [base_spans(t) for t in texts]
        spans = [join_spans(b, m) for b, m in zip(base, model_spans(_restore(weights), texts, how), strict=True)]
        columns = [[redact(t, s) for t, s in zip(texts, spans, strict=True)], map(written, base), map(written, spans)]
        kept = [batch.column(short) for short in own.values()]
        made = [pa.array(list(c), pa.string()) for c in columns]
        return pa.RecordBatch.from_arrays([*kept, *made], [*own.values(), "_text", "_base", "_spans"])

    kept = [f"{short} {source.schema[short].dataType.simpleString()}" for short in own.values()]
    found = map_batches(source, work, ", ".join([*kept, "_text string, _base string, _spans string"]))
    return found.toDF(*keep, "_text", "_base", "_spans")


def redact_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", how: Training = Training()) -> DataFrame:
    """docs with every span replaced by its kind in angle brackets, and the length, if there is one, brought up to date."""
    others = [name for name in docs.columns if name != text]
    found = find_personal_data(docs, others, key, text, how)
    changed = found.toDF(*[f"c{k}" for k in range(len(others))], "_text", "_base", "_spans")
    short = dict(zip(others, changed.columns, strict=False)) | {text: "_text"}
    columns = {name: F.col(short[name]) for name in docs.columns}
    if length in columns:
        columns[length] = F.length("_text").cast(docs.schema[length].dataType)
    return changed.select(*[column.alias(name) for name, column in columns.items()])


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced; of overlapping spans of different kinds the one that starts first, then the longer."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
