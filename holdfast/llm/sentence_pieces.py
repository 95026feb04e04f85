"""SentencePiece ids of whole texts with the bytes of the text that each piece stands for, and the text of the ids.

A model carries a compiled character map: a double-array trie of character sequences and what they become. Texts are
normalised here by the longest sequence of the map at each place, and every byte of the normalised text remembers the
place in the original that it came from. The library then cuts the normalised text (with a copy of the model that
normalises nothing more); the pieces' lengths give their places in it and the record projects them to the original bytes.

Long normalised texts are cut between characters x and y that stand side by side in no piece of the vocabulary. Every
merge makes a piece, so no merge spans such a place and the parts' ids are the whole text's ids.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from holdfast.llm.common import map_texts

#: The vocabulary's mark for a space.
MARK = "▁".encode()
#: Normalised texts over this many characters are encoded piece by piece.
CHUNK_CHARS = 1 << 16
#: Field numbers of the model file's messages, and kinds of pieces.
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE, KIND, NAME, CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES, MARK_AS_SUFFIX, BYTE_FALLBACK = 1, 3, 1, 2, 3, 4, 5, 24, 35
NORMAL, OWN_SYMBOL, BYTE = 1, 4, 6


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value, at


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """Number, value and raw bytes of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        first = at
        tag, at = _number(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if kind == 2 else (8 if kind == 1 else 4, at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value, data[first:at]


def message_field(number: int, value: int | bytes) -> bytes:
    """A small number or a run of bytes as a field."""
    def coded(n: int) -> bytes:
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + coded(n >> 7)

    return coded(number << 3) + coded(value) if isinstance(value, int) else coded(number << 3 | 2) + coded(len(value)) + value


def compiled_rules(blob: bytes) -> dict[str, str]:
    """Character sequences of a compiled map and what they become.

    The blob holds the size of the trie, its units of 32 bits, and the replacements, each ended by a zero byte. The trie is
    walked level by level, all nodes of a level at once.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, texts = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size:]
    below = lambda unit: unit >> 10 << ((unit & 512) >> 6)
    letters, rules = np.arange(1, 256), {}
    nodes, keys = below(units[:1]), [b""]
    while len(nodes):
        places = nodes[:, None] ^ letters
        inside = places < len(units)
        found = inside & (units[np.where(inside, places, 0)] & 0x800000FF == letters)
        rows, columns = np.nonzero(found)
        places = places[rows, columns]
        keys = [keys[r] + bytes([c + 1]) for r, c in zip(rows.tolist(), columns.tolist())]
        nodes = places ^ below(units[places])
        for i in np.flatnonzero(units[places] >> 8 & 1).tolist():
            start = int(units[nodes[i]] & 0x7FFFFFFF)
            rules[keys[i].decode()] = texts[start:texts.index(b"\0", start)].decode()
    return rules


def _character_class(letters: set[str]) -> str:
    return "[" + "".join(map(re.escape, sorted(letters))) + "]"


class Normaliser:
    """Longest-prefix replacement by a character map, spaces as the model wants them, and the record of places."""

    def __init__(self, rules: dict[str, str], symbols: set[str], prefix: bool, suffix: bool, squeeze: bool, escape: bool):
        self.rules, self.prefix, self.suffix, self.squeeze, self.escape = rules, prefix, suffix, squeeze, escape
        # The model's own symbols stay as they are and go before all rules.
        self.symbols, self.longest_symbol = symbols, max(map(len, symbols), default=0)
        self.longest = max(map(len, rules), default=0)
        single, pairs = {k for k in rules if len(k) == 1}, {(k[0], k[1]) for k in rules if len(k) > 1}
        single |= {s for s in symbols if len(s) == 1}
        pairs |= {(s[0], s[1]) for s in symbols if len(s) > 1}
        tests = [_character_class(single)] if single else []
        if pairs:
            tests.append(f"{_character_class({a for a, _ in pairs})}(?={_character_class({b for _, b in pairs})})")
        #: Places where a rule may begin; everywhere else a character stands for itself.
        self.candidates = re.compile("|".join(tests)) if tests else None

    def longest_prefix(self, text: str, at: int) -> tuple[str | None, int]:
        """Replacement of the longest symbol or rule that begins at a place, and the characters it takes."""
        for n in range(min(self.longest_symbol, len(text) - at), 0, -1):
            if text[at:at + n] in self.symbols:
                return text[at:at + n], n
        for n in range(min(self.longest, len(text) - at), 0, -1):
            new = self.rules.get(text[at:at + n])
            if new is not None:
                return new, n
        return None, 1

    def mapped(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Bytes after the map, the original place of each, and the place among them where its replacement begins; and the
        original place of the first replacement by nothing, or the end."""
        data = np.frombuffer(text.encode(), np.uint8)
        own = np.arange(len(data), dtype=np.int32)
        first = np.maximum.accumulate(np.where(data & 0xC0 != 0x80, own, 0)) if len(data) else own
        if self.candidates is None:
            return data, first, first, len(data)
        starts = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data)).astype(np.int32)
        parts, places, heads, done, size, gap = [], [], [], 0, 0, len(data)

        def copy(until: int) -> None:
            nonlocal size
            a, b = starts[done], starts[until]
            parts.append(data[a:b])
            places.append(first[a:b])
            heads.append(first[a:b] - a + size)
            size += b - a

        while (hit := self.candidates.search(text, done)) is not None:
            at = hit.start()
            new, taken = self.longest_prefix(text, at)
            copy(at + (new is None))
            if new == "":
                gap = min(gap, int(starts[at]))
            elif new is not None:
                new = np.frombuffer(new.encode(), np.uint8)
                parts.append(new)
                places.append(np.full(len(new), starts[at], np.int32))
                heads.append(np.full(len(new), size, np.int32))
                size += len(new)
            done = at + taken
        copy(len(starts) - 1)
        return np.concatenate(parts), np.concatenate(places), np.concatenate(heads).astype(np.int32), gap

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised text and for each of its bytes, and its end, the original byte it stands for."""
        if not text:
            return b"", np.zeros(1, np.int32)
        data, places, heads, gap = self.mapped(text)
        total = len(text.encode())
        begin = 0
        if self.squeeze:
            space, own = data == 32, np.arange(len(data))
            # Where the text begins: the first replacement that is not just a space.
            alone = (heads == own) & (np.append(heads[1:], len(data)) == own + 1)
            solid = np.flatnonzero(~(space & alone))
            if not len(solid) and gap == total:
                return b"", np.full(1, total, np.int32)
            begin = min(int(places[solid[0]]) if len(solid) else total, gap)
            # A replacement loses the spaces it begins with where a space or nothing stands before it. A space is among
            # these if the last other byte stands before its replacement.
            other = np.maximum.accumulate(np.where(space, -1, own)) if len(data) else own
            dropped = space & ((heads == 0) | space[heads - 1]) & (other < heads)
            data, places = data[~dropped], places[~dropped]
        if self.escape:
            places = np.repeat(places, np.where(data == 32, 3, 1))
            data = data.tobytes().replace(b" ", MARK)
        else:
            data = data.tobytes()
        mark = MARK if self.escape else b" "
        if self.prefix and not self.suffix:
            data, places = mark + data, np.concatenate([np.full(len(mark), begin, np.int32), places])
        if self.squeeze:
            kept = len(data)
            while data.endswith(mark, 0, kept):
                kept -= len(mark)
            if kept < len(data):
                total, data, places = int(places[kept]), data[:kept], places[:kept]
        if self.prefix and self.suffix:
            data, places = data + mark, np.concatenate([places, np.full(len(mark), total, np.int32)])
        return data, np.append(places, np.int32(total))


class PieceCoder:
    """Encodes texts with spans and decodes ids, as the library does with the model of a file."""

    def __init__(self, model: bytes, chunk: int = CHUNK_CHARS):
        pieces, kinds, others, self.chunk = [], [], [], chunk
        normaliser, trainer = {}, {}
        for number, value, raw in message_fields(model):
            if number == PIECES:
                own = {n: v for n, v, _ in message_fields(value)}
                pieces.append(own[PIECE].decode())
                kinds.append(own.get(KIND, NORMAL))
            elif number == NORMALISER:
                normaliser = {n: v for n, v, _ in message_fields(value)}
            if number == TRAINER:
                trainer = {n: v for n, v, _ in message_fields(value)}
            if number != NORMALISER:
                others.append(raw)
        self.normalise = Normaliser(
            compiled_rules(normaliser.get(CHARACTER_MAP, b"")), {p for p, k in zip(pieces, kinds) if k == OWN_SYMBOL},
            bool(normaliser.get(DUMMY_PREFIX, 1)), bool(trainer.get(MARK_AS_SUFFIX, 0)),
            bool(normaliser.get(REMOVE_SPACES, 1)), bool(normaliser.get(ESCAPE_SPACES, 1)))
        plain = b"".join([message_field(NAME, b"identity"), message_field(DUMMY_PREFIX, 0), message_field(REMOVE_SPACES, 0),
                          message_field(ESCAPE_SPACES, normaliser.get(ESCAPE_SPACES, 1))])
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=b"".join(others) + message_field(NORMALISER, plain))
        self.joined = {pair for piece in pieces for pair in zip(piece, piece[1:])}
        self.all_bytes = bool(trainer.get(BYTE_FALLBACK, 0))
        self.lengths = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(pieces, kinds)], np.int64)

    def parts(self, text: str) -> list[str]:
        """A normalised text cut where no piece of the vocabulary can span."""
        out, start = [], 0
        while len(text) - start > self.chunk:
            cut = next((i for i in range(start + self.chunk, len(text)) if (text[i - 1], text[i]) not in self.joined), None)
            if cut is None:
                break
            out.append(text[start:cut])
            start = cut
        return [*out, text[start:]]

    def pieces(self, texts: list[str]) -> list[tuple[list[int], np.ndarray]]:
        """Ids of normalised texts and the number of bytes of each piece."""
        cut = [self.parts(t) for t in texts]
        flat = [p for parts in cut for p in parts]
        if self.all_bytes:
            found = self.cutter.encode(flat, num_threads=1)
            sized = [(ids, self.lengths[ids] if ids else np.zeros(0, np.int64)) for ids in found]
        else:
            # Without byte pieces an unknown piece may have any length, which only its text tells.
            sized = []
            for part in flat:
                own = self.cutter.encode(part, return_type="proto").pieces
                sized.append(([p.id for p in own], np.array([len(p.piece.encode()) for p in own], np.int64)))
        out, at = [], 0
        for parts in cut:
            some = sized[at:at + len(parts)]
            at += len(parts)
            out.append(some[0] if len(some) == 1 else (
                [i for ids, _ in some for i in ids], np.concatenate([lengths for _, lengths in some])))
        return out

    def encode(self, texts: list[str]) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
        """For each text the ids, and the first byte and the end of each piece in the text.

        A piece of the mark put before the text is empty there. Of the byte pieces of one character the last one has it.
        """
        normal = [self.normalise(t) for t in texts]
        out = []
        for (data, places), (ids, lengths) in zip(normal, self.pieces([data.decode() for data, _ in normal])):
            ends = np.cumsum(lengths)
            if (int(ends[-1]) if len(ends) else 0) != len(data):
                raise ValueError("the pieces do not add up to the normalised text")
            out.append((ids, places[ends - lengths], places[ends]))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids) if ids else []


@lru_cache(maxsize=4)
def coder(path: str, chunk: int) -> PieceCoder:
    with open(path, "rb") as file:
        return PieceCoder(file.read(), chunk)


def sentence_pieces(
    docs: DataFrame, path: str, spans: bool = False, chunk: int = CHUNK_CHARS, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (UTF-8 of the decoded text) and span_bytes (bytes
    of the text that pieces stand for) of each whole text; with spans=True also the ids and their spans `begins`, `ends`.

    `path` names the model on every executor. Null and empty texts have no ids and the digests of nothing. Bytes that are
    no UTF-8 are read as U+FFFD. Texts of any length are encoded in parts; their record of places takes four bytes for each
    byte. Each row is treated alone, whatever its key: repeated rows and null keys come back as often, an empty table gives
    no rows. Other columns are not read, whatever their names.
    """

    def work(texts: list[bytes]) -> list[list]:
        own = coder(path, chunk)
        found = own.encode([t.decode("utf-8", "replace") for t in texts])
        ids = [f[0] for f in found]
        columns = [
            list(map(len, ids)),
            [hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for i in ids],
            [hashlib.sha256(t.encode()).hexdigest() for t in own.decode(ids)],
            [int((ends - begins).sum()) for _, begins, ends in found],
        ]
        return columns + ([ids, [f[1] for f in found], [f[2] for f in found]] if spans else [])

    added = "n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long" + (
        ", ids array<int>, begins array<int>, ends array<int>" if spans else "")
    return map_texts(docs, [key], added, work, text)
