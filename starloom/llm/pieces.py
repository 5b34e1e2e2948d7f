"""SentencePiece encoding and decoding with the byte spans of every piece.

The model file holds a compiled character map: a double-array trie over UTF-8
prefixes whose values point to replacement strings. Normalisation repeatedly
takes the longest prefix the trie knows, or else one character, and records for
each normalised byte which source byte it came from. Blanks become the model's
space mark; leading, trailing and repeated blanks and the dummy prefix follow
the model's settings. Each piece covers a run of normalised bytes, and the
record projects it to a span of the original UTF-8 text.

Where no piece of the vocabulary holds anything before a space mark, or a line
end, a text can be cut there without changing its pieces. Cut texts repeat their
parts very often, so a worker encodes each part once (a memory bounded in parts
and bytes, flat, so that a part costs little beyond its own bytes). The library
itself merges the pieces; exactness is that of the library.

Edge cases: a null text is empty and has no pieces; a text of blanks follows the
model's settings; characters outside the vocabulary become byte pieces, or the
unknown piece; equal texts have equal results; repeated rows stay.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from starloom.llm.frames import map_batches, texts_of
from starloom.llm.textscan import Spans, gather

SPACE = "▁".encode()
# A worker forgets all parts when it holds more, of either.
REMEMBERED_PARTS, REMEMBERED_BYTES = 100_000, 8 << 20


class CharMap:
    """The compiled character map: longest known prefix and its replacement."""

    def __init__(self, blob: bytes):
        self.units, self.values = np.zeros(0, np.uint32), b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
            self.values = blob[4 + size :]

    def longest(self, data: bytes, start: int) -> tuple[int, bytes]:
        """(length, replacement) of the longest known prefix of data[start:]; length 0 if none is known."""
        best = (0, b"")
        if not len(self.units):
            return best
        node = self._offset(self.units[0])
        for k in range(start, len(data)):
            node ^= data[k]
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                at = self.units[node] & 0x7FFFFFFF
                best = (k + 1 - start, self.values[at : self.values.index(0, at)])
        return best

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


@dataclass
class Normaliser:
    """The model's normalisation, with the source byte of every normalised byte."""

    chars: CharMap
    dummy_prefix: bool
    squeeze: bool
    escape: bool
    identity: bool = field(init=False)

    def __post_init__(self):
        self.identity = not len(self.chars.units) and not self.squeeze and self.escape

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source byte offset per normalised byte and one past the end)."""
        data = text.encode("utf-8", "surrogatepass")
        if self.identity:
            return self._unchanged(data)
        out, source = bytearray(), []
        at, end = 0, len(data)
        units = []
        while at < end:
            size, value = self.chars.longest(data, at)
            if not size:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                value = data[at : at + size]
            units.append((at, value))
            at += size
        if self.squeeze:
            while units and not units[0][1].strip(b" "):
                units.pop(0)
        space = SPACE if self.escape else b" "
        if units and self.dummy_prefix:
            out += space
            source += [units[0][0]] * len(space)
        blank = bool(self.squeeze)
        for start, value in units:
            if self.squeeze and blank:
                value = value.lstrip(b" ")
            if not value:
                continue
            whole = value.replace(b" ", space)
            out += whole
            source += range(start, start + len(whole)) if whole == data[start : start + len(whole)] else [start] * len(whole)
            blank = value.endswith(b" ")
        if self.squeeze:
            while out.endswith(space):
                end = source[len(out) - len(space)]
                del out[len(out) - len(space) :]
        return bytes(out), np.array([*source[: len(out)], end], np.int64)

    def _unchanged(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map and squeezing only blanks change: each becomes the space mark."""
        lead = len(SPACE) if data and self.dummy_prefix else 0
        normal = SPACE[:lead] + data.replace(b" ", SPACE)
        widths = np.where(np.frombuffer(data, np.uint8) == 0x20, len(SPACE), 1)
        source = np.repeat(np.arange(len(data)), widths)
        return normal, np.concatenate((np.zeros(lead, np.int64), source, [len(data)]))


@dataclass
class Encoded:
    """Per text: ids, source bytes per piece, decoded text in UTF-8. decimal holds every id in decimal, and where each starts."""

    ids: list[np.ndarray]
    widths: list[np.ndarray]
    decoded: list[bytes]
    decimal: tuple[np.ndarray, np.ndarray]

    @property
    def numbers(self) -> Iterator[bytes]:
        """Per text the ids in decimal, joined by commas."""
        digits, starts = self.decimal
        for own in self.ids:
            yield gather(digits, starts[own], starts[own + 1] - starts[own])[:-1].tobytes()


class Remembered:
    """Parts with their ids and decoded texts, which lie one after the other in two arrays."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.ids, self.id_ends = array("i"), array("q", [0])
        self.texts, self.text_ends = bytearray(), array("q", [0])

    def full(self) -> bool:
        return len(self.places) > REMEMBERED_PARTS or len(self.texts) > REMEMBERED_BYTES

    def add(self, part: bytes, ids: list[int], text: str) -> None:
        self.places[part] = len(self.places)
        self.ids.extend(ids)
        self.id_ends.append(len(self.ids))
        self.texts += text.encode()
        self.text_ends.append(len(self.texts))

    def found(self, places: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and decoded bytes of the parts at these places, and where those from each of the bounds on start."""
        made = []
        for held, ends, kind in ((self.ids, self.id_ends, np.intc), (self.texts, self.text_ends, np.uint8)):
            edges = np.frombuffer(ends, np.int64)
            lengths = edges[places + 1] - edges[places]
            made += [gather(np.frombuffer(held, kind), edges[places], lengths), np.concatenate(([0], np.cumsum(lengths)))[bounds]]
        return tuple(made)


class Pieces:
    """Encoder and decoder for one model file."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.normalise = Normaliser(
            CharMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        )
        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        single = [library.is_byte(i) for i in range(len(names))]
        mark = SPACE.decode()
        numbers = [f"{i},".encode() for i in range(len(names))]
        self.decimal = np.frombuffer(b"".join(numbers), np.uint8), np.cumsum([0, *map(len, numbers)])
        self.lengths = np.array([1 if b else len(n.encode()) for n, b in zip(names, single, strict=True)])
        self.marks = np.array([0 if b else n.count(mark) for n, b in zip(names, single, strict=True)])
        user_defined, bpe = 4, 2
        self.cuttable = (
            self.normalise.identity
            and proto.trainer_spec.byte_fallback
            and proto.trainer_spec.model_type == bpe
            and all(piece.type != user_defined for piece in proto.pieces)
            and not any(mark in n.lstrip(mark) or "\n" in n for n, b in zip(names, single, strict=True) if not b)
        )
        if self.cuttable:
            proto.normalizer_spec.add_dummy_prefix = False
            self.parts = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.known = Remembered()

    def encode(self, texts: list[str]) -> Encoded:
        """The pieces of all texts."""
        if not self.cuttable or any("▁" in text for text in texts):
            return self._encode_whole(texts)
        lead = b" " if self.normalise.dummy_prefix else b""
        data = [lead + text.encode() if text else b"" for text in texts]
        offsets = np.concatenate(([0], np.cumsum([len(own) for own in data])))
        raw = b"".join(data)
        starts = self._cuts(np.frombuffer(raw, np.uint8), offsets)
        ends = np.append(starts[1:], len(raw)) if len(starts) else starts
        hashes = Spans(np.frombuffer(raw, np.uint8)).hash_spans(starts, ends)
        _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        parts = [raw[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        if self.known.full():
            self.known = Remembered()
        self._remember([part for part in parts if part not in self.known.places])
        places = np.fromiter(map(self.known.places.__getitem__, parts), np.int64, len(parts))
        ids, id_edges, decoded, edges = self.known.found(places[place], np.searchsorted(starts, offsets))
        widths = (self.lengths[ids] - (len(SPACE) - 1) * self.marks[ids]).astype("<i4")
        cut = list(zip(id_edges[:-1].tolist(), id_edges[1:].tolist(), strict=True))
        if lead:
            widths[[i for i, j in cut if i < j]] -= 1  # the dummy prefix is no part of the text
        texts_out = [decoded[i + len(lead) : j].tobytes() for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return Encoded([ids[i:j] for i, j in cut], [widths[i:j] for i, j in cut], texts_out, self.decimal)

    @staticmethod
    def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts start: a line end, what follows it, and a run of blanks with the word after it."""
        before = np.empty_like(data)
        before[1:] = data[:-1]
        before[:1] = 0x0A
        starts = (data == 0x0A) | (before == 0x0A) | (data == 0x20) & (before != 0x20)
        starts[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(starts)

    def _remember(self, parts: list[bytes]) -> None:
        """Encode parts and keep their ids and decoded texts."""
        for first in range(0, len(parts), 1000):
            some = parts[first : first + 1000]
            encoded = self.parts.encode([part.decode() for part in some], num_threads=1)
            decoded = self.parts.decode(encoded, num_threads=1)
            for part, ids, text in zip(some, encoded, decoded, strict=True):
                self.known.add(part, ids, text)

    def _encode_whole(self, texts: list[str]) -> Encoded:
        ids = self.library.encode(texts, num_threads=1)
        ends = [self.spans(text, own)[:, 1] for text, own in zip(texts, ids, strict=True)]
        return Encoded(
            [np.array(own, "<i4") for own in ids],
            [np.diff(own, prepend=0).astype("<i4") for own in ends],
            [own.encode() for own in self.library.decode(ids, num_threads=1)],
            self.decimal,
        )

    def spans(self, text: str, ids: list[int]) -> np.ndarray:
        """[pieces, 2]: start and end of each piece in the bytes of the original text.

        An unknown piece reaches to the next place of the piece after it, or to
        the end; if another unknown piece follows, it covers one character.
        """
        normal, source = self.normalise(text)
        lengths = self.lengths[ids] if len(ids) else np.zeros(0, np.int64)
        unknown = self.library.unk_id()
        if unknown in ids:
            lengths = self._with_unknown(normal, ids, lengths.copy(), unknown)
        ends = np.cumsum(lengths)
        return np.stack([source[ends - lengths], source[ends]], 1)

    def _with_unknown(self, normal: bytes, ids: list[int], lengths: np.ndarray, unknown: int) -> np.ndarray:
        at = 0
        for k, own in enumerate(ids):
            if own == unknown:
                after = ids[k + 1] if k + 1 < len(ids) else None
                one = at + len(normal[at:].decode("utf-8", "replace")[:1].encode())
                if after is None:
                    end = len(normal)
                else:
                    end = one if after == unknown else normal.find(self.library.id_to_piece(after).encode(), one)
                lengths[k] = max(end, one) - at
            at += int(lengths[k])
        return lengths


@lru_cache(maxsize=2)
def load(name: str) -> Pieces:
    """The model that the driver sent to every executor under this name."""
    with open(SparkFiles.get(name), "rb") as file:
        return Pieces(file.read())


def send_model(spark, path: str) -> str:
    """Send the model file to the executors; the name to load it by."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rpartition("/")[2]


def _encoded(docs: DataFrame, model: str, key: str, text: str, columns: str, fill, kept: tuple[str, ...] = ()) -> DataFrame:
    """docs' key and kept columns with the columns that fill makes of the encoded texts, a few hundred texts at a time."""
    name = send_model(docs.sparkSession, model)
    own = [f"_kept{k}" for k in range(len(kept))]
    source = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), *(F.col(c).alias(o) for c, o in zip(kept, own, strict=True)))
    names = ["_id", *own, *(part.split()[0] for part in columns.split(", "))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for first in range(0, batch.num_rows, 250):
            some = batch.slice(first, 250)
            found = load(name).encode(texts_of(some, "_text"))
            made.append(pa.RecordBatch.from_arrays([some.column("_id"), *map(some.column, own), *fill(found)], names))
        return pa.Table.from_batches(made).combine_chunks().to_batches()[0]

    kinds = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in ("_id", *own))
    return map_batches(source, work, f"{kinds}, {columns}").withColumnsRenamed({"_id": key, **dict(zip(own, kept, strict=True))})


def encode_documents(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded, starts, ends) per row of docs; starts and ends are the pieces' bytes in the UTF-8 text."""

    def fill(found: Encoded) -> list[pa.Array]:
        ends = [np.cumsum(widths, dtype=np.int32) for widths in found.widths]
        starts = [end - widths for end, widths in zip(ends, found.widths, strict=True)]
        lists = pa.list_(pa.int32())
        decoded = pa.array([own.decode() for own in found.decoded], pa.string())
        return [pa.array(found.ids, lists), decoded, pa.array(starts, lists), pa.array(ends, lists)]

    return _encoded(docs, model, key, text, "ids array<int>, decoded string, starts array<int>, ends array<int>", fill)


def encoding_digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, ends_sha256) per row: what encode_documents returns, digested in the task.

    ends_sha256 is of the little-endian 32-bit ends of all pieces; each piece starts where the one before ends.
    """

    def digests(values) -> pa.Array:
        return pa.array([hashlib.sha256(value).hexdigest() for value in values], pa.string())

    def fill(found: Encoded) -> list[pa.Array]:
        ends = (np.cumsum(widths, dtype="<i4").tobytes() for widths in found.widths)
        amounts = pa.array([len(own) for own in found.ids], pa.int64())
        return [amounts, digests(found.numbers), digests(found.decoded), digests(ends)]

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string, ends_sha256 string"
    return _encoded(docs, model, key, text, columns, fill)


def training_tokens(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", kept: tuple[str, ...] = ()) -> DataFrame:
    """(key, kept, n_tokens, ids, decoded_sha256) per row: the tokens to train on, and the digest of the text decoded from them."""

    def fill(found: Encoded) -> list[pa.Array]:
        amounts = pa.array([len(own) for own in found.ids], pa.int64())
        decoded = pa.array([hashlib.sha256(value).hexdigest() for value in found.decoded], pa.string())
        return [amounts, pa.array(found.ids, pa.list_(pa.int32())), decoded]

    return _encoded(docs, model, key, text, "n_tokens long, ids array<int>, decoded_sha256 string", fill, kept)
