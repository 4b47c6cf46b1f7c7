"""Words of letters and digits: ASCII letters lower-cased, ASCII digits, and every character beyond ASCII.

All other ASCII characters separate words. Lower-casing touches A-Z only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clickweave.llm import common

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: What each byte of UTF-8 text becomes; bytes beyond ASCII belong to word characters.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def split(texts: pa.Array) -> pa.Array:
    """Lists of words, with empty ones where separators meet; null texts have none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return pa.array([], pa.list_(pa.large_string()))
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(_BYTES) if ends[-1] > ends[0] else b""
    own = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(ends - ends[0])), pa.py_buffer(data)])
    return pc.split_pattern(own, " ")


def hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes (2 and more) of all words, text after text, and each text's number of words."""
    found, counts = common.hashed_words(split(texts))
    return found, counts.astype(np.int64)


def batches(column: pa.Array, most_chars: int):
    """Slices of a text column of about `most_chars` bytes each; no text is cut."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        begun = sizes[start - 1] if start else 0
        end = min(len(column), int(np.searchsorted(sizes, begun + most_chars)) + 1)
        yield slice(start, end)
        start = end


#: DuckDB's list of a text's words.
SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
