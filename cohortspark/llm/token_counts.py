"""Token counts by overlap resynchronisation.

Texts up to chunk_bytes are encoded whole. A longer text is cut into chunks that overlap; neighbouring encodings
are spliced at the first boundary in the overlap that is stable: both encodings end a piece there, and the text
goes from a non-space to a space. No piece of the vocabulary has a space after another character (checked when
the model is loaded), so no merge can ever reach over such a place and both sides encode as in the whole text.
Where the overlap holds no such place, or the encoded bytes do not add up to the chunk's, the overlap is doubled,
up to the end of the text, which is then encoded whole.

Defined results: a null or empty text has 0 tokens and 0 bytes; repeated rows give repeated rows; a null doc_id
stays null; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks int"
MODEL = "piece_bpe_32k.model"
SPACE = "▁"


def resolve(model: str) -> str:
    """A path stays; a bare file name is looked up among the public tokenizers of the machine that asks."""
    if os.path.sep in model:
        return model
    import public_tokenizers

    return public_tokenizers.path(model)


class Counter:
    """Counts pieces of one model; one per Python worker."""

    _loaded: dict[tuple, Counter] = {}

    def __init__(self, model: str, chunk_bytes: int, overlap_bytes: int) -> None:
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=resolve(model))
        self.chunk, self.overlap = chunk_bytes, overlap_bytes
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.cut_is_safe = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.width = np.array([1 if self.sp.is_byte(i) else len(p.replace(SPACE, " ").encode()) for i, p in enumerate(pieces)])

    @classmethod
    def get(cls, *args) -> Counter:
        if args not in cls._loaded:
            cls._loaded[args] = cls(*args)
        return cls._loaded[args]

    def ends(self, part: bytes) -> np.ndarray | None:
        """Byte offsets in part at which its pieces end; None if they do not add up."""
        ids = self.sp.encode(part.decode(), num_threads=1)
        ends = np.cumsum(self.width[ids]) - 1  # the encoder puts a space before the text
        return ends if len(ends) and ends[-1] == len(part) else None

    def long(self, text: str) -> tuple[int, int]:
        """(tokens, chunks) of a long text."""
        raw = text.replace(SPACE, " ").encode()  # the encoder takes both for a space
        if not self.cut_is_safe:
            return len(self.sp.encode(text, num_threads=1)), 1
        at, tokens, chunks, start, overlap = -1, 0, 0, 0, self.overlap  # a first piece of the added space alone ends at 0
        ends = None  # of the chunk from start; what lies before `at` is counted
        while True:
            stop = min(len(raw), start + self.chunk + overlap)
            while stop < len(raw) and raw[stop] & 0xC0 == 0x80:
                stop += 1
            ends = self.ends(raw[start:stop])
            if ends is None:
                if stop == len(raw) and start == 0:
                    return len(self.sp.encode(text, num_threads=1)), chunks + 1
                start, at, tokens, overlap = 0, -1, 0, max(2 * overlap, len(raw) // 8)
                continue
            chunks += 1
            ends = ends + start
            if stop == len(raw):
                return tokens + int((ends > at).sum()), chunks
            next_start = start + self.chunk
            while raw[next_start] & 0xC0 == 0x80:
                next_start += 1
            cut = self.stable(raw, ends, next_start, stop)
            if cut is None:
                overlap *= 2
                continue
            tokens += int(((ends > at) & (ends <= cut)).sum())
            start, at, overlap = next_start, cut, self.overlap

    def stable(self, raw: bytes, ends: np.ndarray, start: int, stop: int) -> int | None:
        """The first stable boundary in raw[start:stop] that the encoding of that part has too."""
        other = self.ends(raw[start:stop])
        if other is None:
            return None
        both = np.intersect1d(ends[(ends > start) & (ends < stop)], other + start, assume_unique=True)
        b = np.frombuffer(raw, np.uint8)
        both = both[(b[both] == 32) & (b[both - 1] != 32)]
        return int(both[0]) if len(both) else None

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n, chunks = np.zeros(len(texts), np.int64), np.ones(len(texts), np.int32)
        short = [i for i, t in enumerate(texts) if len(t) * 4 <= self.chunk or len(t.encode()) <= self.chunk]
        for i, ids in zip(short, self.sp.encode([texts[i] for i in short], num_threads=1), strict=True):
            n[i] = len(ids)
        for i in set(range(len(texts))) - set(short):
            n[i], chunks[i] = self.long(texts[i])
        return n, chunks


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = 4096, chunk_bytes: int = 1 << 15, overlap_bytes: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and n_chunks (encodings that were spliced) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.get(model, chunk_bytes, overlap_bytes)
        for b in common.slices(batches, 1 << 20):
            col = common.text_column(b)
            n, chunks = counter.counts(col.to_pylist())
            _, off = common.buffers(col)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit), pa.array(chunks)], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(common.table(spark, sf_dir, "documents"))
