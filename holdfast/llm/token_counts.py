"""Token counts of whole texts; huge texts are encoded in overlapping chunks that are joined at proven boundaries.

A position between characters x and y is *stable* if no piece of the vocabulary contains x directly before y. Every merge
of the encoder makes a piece of the vocabulary, so no merge spans a stable position, and what stands on one side of it
cannot change how the other side is cut. Two chunks are joined at a stable position inside their overlap where both
encodings have a token boundary: tokens left of it are counted in the first chunk, the others in the second. The mark
that the library puts before a chunk reaches only up to the first stable position, so joins lie behind the start of the
overlap. If an overlap holds no such position it is doubled, until it is found or the text ends.
"""

from functools import lru_cache

import sentencepiece
from pyspark.sql import DataFrame

from holdfast.llm.common import map_texts

#: Texts over this many bytes are encoded in chunks of this size.
CHUNK_BYTES = 1 << 16
#: First overlap of neighbouring chunks.
OVERLAP_BYTES = 256
#: The vocabulary's mark for a space.
SPACE_MARK = "▁"


class Resynchroniser:
    """Counts tokens of texts of any length with memory for one chunk."""

    def __init__(self, path: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.joined = {pair for piece in pieces for pair in zip(piece, piece[1:])}
        self.chunk, self.overlap = chunk, overlap

    def counts(self, texts: list[bytes]) -> list[int]:
        whole = [i for i, text in enumerate(texts) if len(text) <= self.chunk]
        out = [0] * len(texts)
        short = [texts[i].decode("utf-8", "replace") for i in whole]
        for i, ids in zip(whole, self.model.encode(short, num_threads=1)):
            out[i] = len(ids)
        for i, text in enumerate(texts):
            if len(text) > self.chunk:
                out[i] = self.long_count(text)
        return out

    def starts(self, data: bytes) -> list[int]:
        """Byte offset of each token's first character; all bytes of one unknown character start with it."""
        return [piece.begin for piece in self.model.encode(data.decode("utf-8"), return_type="proto").pieces]

    def stable(self, data: bytes, low: int, high: int) -> list[int]:
        """Stable byte positions p of `data` with low < p < high, the last first."""
        text = data[low:high].decode("utf-8").replace(" ", SPACE_MARK)
        found, at = [], low
        for left, right in zip(text, text[1:]):
            at += 1 if left == SPACE_MARK and data[at:at + 1] == b" " else len(left.encode())
            if (left, right) not in self.joined:
                found.append(at)
        return found[::-1]

    def long_count(self, data: bytes) -> int:
        data = data.decode("utf-8", "replace").encode()  # offsets need well-formed text
        begin, skip, total = 0, 0, 0
        starts, end = self.encoded(data, begin, self.chunk)
        while end < len(data):
            overlap = self.overlap
            while True:
                low = character_start(data, max(begin + skip, end - overlap))
                following, next_end = self.encoded(data, low, end - low + self.chunk)
                own, others = {begin + s for s in starts}, {low + s for s in following}
                join = next((p for p in self.stable(data, low, end) if p in own and p in others), None)
                if join is not None:
                    total += sum(s >= skip and begin + s < join for s in starts)
                    begin, skip, starts, end = low, join - low, following, next_end
                    break
                if low <= begin + skip or end - low >= self.chunk:
                    # Nothing between the last join and here can be cut: lengthen the chunk itself.
                    starts, end = self.encoded(data, begin, 2 * (end - begin))
                    if end >= len(data):
                        break
                overlap *= 2
        return total + sum(s >= skip for s in starts)

    def encoded(self, data: bytes, begin: int, size: int) -> tuple[list[int], int]:
        end = character_start(data, min(len(data), begin + size))
        return self.starts(data[begin:end]), end


def character_start(data: bytes, at: int) -> int:
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


@lru_cache(maxsize=4)
def resynchroniser(path: str, chunk: int, overlap: int) -> Resynchroniser:
    return Resynchroniser(path, chunk, overlap)


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """n_bytes, n_tokens and over_limit (n_tokens > limit) of each row's whole text.

    Null and empty texts have no bytes and no tokens. Rows are counted one by one: repeated rows, null keys and an empty
    table give as many rows as they have. Other columns of the input are not read.
    """

    def work(texts: list[bytes]) -> list[list]:
        counts = resynchroniser(path, chunk, overlap).counts(texts)
        return [[len(t) for t in texts], counts, [n > limit for n in counts]]

    return map_texts(docs, [key], "n_bytes long, n_tokens long, over_limit boolean", work, text)
