"""Token counts of whole texts, with huge texts cut into overlapping chunks.

A text above ``chunk_bytes`` is encoded chunk by chunk.  Neighbouring chunks
overlap; both encodings carry byte offsets, and they are spliced where both
start a token at the same proven stable boundary.  If the overlap has none,
the left chunk is widened until one is found or the text ends.

A boundary is proven stable as follows.  The piece vocabulary holds no piece
with a word mark after another character (checked when the model is loaded),
so no merge ever joins a character to a space that follows it: what stands
before such a space and what starts with it are encoded independently of each
other.  The first, cut word of a right chunk and the last, cut word of a left
chunk lie outside the spliced range.

Peak memory is one chunk's encoding; the spliced count equals the library's
count of the whole text.  Files ending in .json are counted whole by their
library, without special tokens.

Defined cases: null and empty texts have 0 bytes and 0 tokens; an empty table
gives no rows; repeated rows are counted each; extra columns are not read by
the counter and pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_arrow, text_bytes, widened

CHUNK_BYTES = 32_768
OVERLAP_BYTES = 512
MARK = "▁"
_SPACES = (b" ", MARK.encode())
_MODELS: dict = {}


def _has_inner_mark(piece: str) -> bool:
    return any(b == MARK != a for a, b in zip(piece, piece[1:], strict=False))


class PieceCounter:
    """Counts pieces with a sentencepiece model; texts are bytes."""

    def __init__(self, path: str, chunk_bytes: int = CHUNK_BYTES, overlap_bytes: int = OVERLAP_BYTES):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk_bytes, overlap_bytes
        self.splits = not any(_has_inner_mark(self.sp.id_to_piece(i)) for i in range(self.sp.get_piece_size()))

    def count(self, texts: list[bytes]) -> list[int]:
        out = [0] * len(texts)
        small = [i for i, b in enumerate(texts) if b and (len(b) <= self.chunk or not self.splits)]
        for at in range(0, len(small), 64):
            part = small[at:at + 64]
            for i, ids in zip(part, self.sp.encode([texts[i].decode() for i in part], num_threads=1), strict=True):
                out[i] = len(ids)
        done = set(small)
        for i, b in enumerate(texts):
            if b and i not in done:
                out[i] = self.count_long(b)
        return out

    def _starts(self, b: bytes, lo: int, hi: int) -> list[int]:
        """Byte offsets in the text where the pieces of b[lo:hi] start."""
        return [lo + p.begin for p in self.sp.encode(b[lo:hi].decode(), return_type="proto").pieces]

    def _stable(self, b: bytes, lo: int, hi: int, left: list[int], right: list[int]) -> int | None:
        """The last proven boundary inside (lo, hi) at which both encodings start a piece."""
        both = set(left) & set(right)
        for p in sorted((x for x in both if lo < x < hi), reverse=True):
            if b.startswith(_SPACES, p) and not b.endswith(_SPACES, lo, p):
                return p
        return None

    def count_long(self, b: bytes) -> int:
        total, done, lo, width = 0, 0, 0, self.chunk
        left = None
        while True:
            hi = _char_start(b, min(len(b), lo + width))
            left = self._starts(b, lo, hi) if left is None else left
            if hi >= len(b):
                return total + sum(1 for p in left if p >= done)
            start = _char_start(b, max(lo + 1, hi - self.overlap))
            end = _char_start(b, min(len(b), start + self.chunk))
            right = self._starts(b, start, end)
            cut = self._stable(b, max(start, done), hi, left, right)
            if cut is None:  # widen the left chunk, and with it the overlap
                width, left = 2 * (hi - lo), None
                continue
            total += sum(1 for p in left if done <= p < cut)
            done, lo, width, left = cut, start, end - start, right


def _char_start(b: bytes, p: int) -> int:
    while p < len(b) and 0x80 <= b[p] < 0xC0:
        p += 1
    return p


class JsonCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.t = Tokenizer.from_file(path)
        self.t.no_truncation()
        self.t.no_padding()

    def count(self, texts: list[bytes]) -> list[int]:
        out: list[int] = []
        for at in range(0, len(texts), 64):
            out += [len(e.ids) for e in self.t.encode_batch([b.decode() for b in texts[at:at + 64]], add_special_tokens=False)]
        return out


def counter(path: str, chunk_bytes: int = CHUNK_BYTES, overlap_bytes: int = OVERLAP_BYTES):
    """The file's counter, loaded once per Python worker."""
    key = (path, chunk_bytes, overlap_bytes)
    if key not in _MODELS:
        _MODELS[key] = JsonCounter(path) if path.endswith(".json") else PieceCounter(path, chunk_bytes, overlap_bytes)
    return _MODELS[key]


def token_counts(docs: DataFrame, path: str, limit: int = 4096, chunk_bytes: int = CHUNK_BYTES,
                 overlap_bytes: int = OVERLAP_BYTES) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    new = "n_bytes long, n_tokens long, over_limit boolean"
    names = [x.split()[0] for x in new.split(", ")]
    keep = [f for f in docs.schema if f.name.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path, chunk_bytes, overlap_bytes)
        for batch in batches:
            texts = list(text_bytes(batch.column("text")))
            n = c.count(texts)
            cols = [batch.column(f.name) for f in keep]
            cols += [pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
            yield pa.record_batch(cols, names=[*(f.name for f in keep), *names])

    return map_arrow(docs, run, widened(keep, new))
