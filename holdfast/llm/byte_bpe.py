"""Byte-level BPE by a local rank file: ids of whole texts, and the bytes that the ids stand for.

Long texts are cut where white space follows another character. No match of the split pattern spans such a place (white
space opens a match or stands in a match of white space alone), nothing in the pattern looks back, and its one look-ahead
concerns white space only; so the pieces' matches are the whole text's matches. Where there is no such place within the
chunk size, the chunk grows to the next one.
"""

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark.sql import DataFrame

from holdfast.llm.common import map_texts

#: Texts over this many characters are encoded piece by piece.
CHUNK_CHARS = 1 << 16
#: Python's \S is white space in no other library; the four characters are white space in all.
_SAFE = re.compile(r"(?<=\S)[ \t\n\r]")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, path: str, pattern: str, size: int = CHUNK_CHARS) -> np.ndarray:
    coder = encoding(path, pattern)
    parts = [np.asarray(coder.encode_ordinary(part), dtype="<u4") for part in safe_chunks(text, size)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def decode(ids: np.ndarray, path: str, pattern: str) -> bytes:
    return encoding(path, pattern).decode_bytes(ids.tolist())


def byte_bpe(
    docs: DataFrame, path: str, pattern: str, ids: bool = False, chunk: int = CHUNK_CHARS, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and decoded_sha256 of each whole text, with
    ids=True also the ids as an array.

    Null and empty texts have no ids and the digests of nothing. Bytes that are no UTF-8 are read as U+FFFD. Each row is
    treated alone, whatever its key; other columns are not read.
    """

    def work(texts: list[bytes]) -> list[list]:
        counts, coded, decoded, arrays = [], [], [], []
        for data in texts:
            found = encode(data.decode("utf-8", "replace"), path, pattern, chunk)
            counts.append(len(found))
            coded.append(hashlib.sha256(found.tobytes()).hexdigest())
            decoded.append(hashlib.sha256(decode(found, path, pattern)).hexdigest())
            arrays.append(found.astype(np.int32) if ids else None)
        return [counts, coded, decoded] + ([arrays] if ids else [])

    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return map_texts(docs, [key], added, work, text)
