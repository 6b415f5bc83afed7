"""Token counts; huge documents are encoded in overlapping chunks and spliced."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
CHUNK_BYTES = 1 << 16
OVERLAP_BYTES = 1 << 10
BATCH_BYTES = 1 << 20
MARK = "▁"


class ChunkedCounter:
    """Counts the tokens of one model, with the offsets of each token in UTF-8 bytes.

    ``splits_at_spaces`` says that no piece of the vocabulary goes on after a space mark that
    follows another character. Merges then never cross the place before a space that
    follows something else: whatever stands on the left, the tokens from there on are the
    same. Such places are the proven stable boundaries at which chunks are spliced.
    """

    def __init__(self, path: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.splits_at_spaces = not any(MARK in piece.lstrip(MARK) for piece in pieces)
        self.widths = np.array(
            [
                1 if self.model.is_byte(i) else len(piece.replace(MARK, " ").encode())
                for i, piece in enumerate(pieces)
            ]
        )

    def _ends(self, raw: bytes) -> np.ndarray | None:
        """Where each token ends, or None if the tokens do not spell the bytes.

        The model sets a space before the text, which the first token's width counts.
        """
        ends = np.cumsum(self.widths[self.model.encode(raw.decode("utf-8"))]) - 1
        return ends if len(ends) and ends[-1] == len(raw) else None

    def count(self, text: str) -> int:
        raw = text.encode("utf-8")
        if len(raw) <= self.chunk or not self.splits_at_spaces:
            return len(self.model.encode(text))
        spliced = self._spliced(raw)
        return len(self.model.encode(text)) if spliced is None else spliced

    def _spliced(self, raw: bytes) -> int | None:
        """Tokens of a long text, or None where its chunks cannot be lined up.

        Tokens are counted by where they end. The first may be the lone space mark set before
        the text, which ends at 0, so counting starts behind -1.
        """
        total, low, joint, overlap = 0, 0, -1, self.overlap
        high = self._character_start(raw, self.chunk)
        ends = self._ends(raw[low:high])
        while ends is not None and high < len(raw):
            # The next chunk begins within this one; both must have a token boundary at a
            # stable place of the part they share.
            again = self._character_start(raw, max(high - overlap, joint + 1))
            far = self._character_start(raw, min(again + self.chunk, len(raw)))
            later = self._ends(raw[again:far]) if far > high else None
            if later is None:
                return None
            place = self._common_boundary(raw, again, high, low + ends, again + later)
            if place is None:
                if again <= joint + 1:
                    return None
                overlap *= 2
                continue
            total += int(np.count_nonzero((low + ends > joint) & (low + ends <= place)))
            low, high, ends, joint, overlap = again, far, later, place, self.overlap
        if ends is None:
            return None
        return total + int(np.count_nonzero(low + ends > joint))

    @staticmethod
    def _character_start(raw: bytes, at: int) -> int:
        while at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += 1
        return at

    @staticmethod
    def _common_boundary(
        raw: bytes, low: int, high: int, left: np.ndarray, right: np.ndarray
    ) -> int | None:
        """The last stable place of raw[low:high] at which tokens of both chunks end."""
        part = np.frombuffer(raw, np.uint8)[low:high]
        spaces = np.flatnonzero((part[1:] == 0x20) & (part[:-1] != 0x20)) + 1 + low
        both = spaces[np.isin(spaces, left) & np.isin(spaces, right)]
        return int(both[-1]) if len(both) else None


def token_counts(
    docs: DataFrame,
    model_path: str | None = None,
    limit: int = LIMIT,
    chunk: int = CHUNK_BYTES,
    overlap: int = OVERLAP_BYTES,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every document.

    ``model_path`` is the place of a sentencepiece model on the workers, by default the
    installed piece_bpe_32k.model. No begin or end tokens are counted. Documents of up to
    ``chunk`` bytes are encoded in groups; a longer one in chunks that overlap by
    ``overlap`` bytes, twice as much wherever two chunks have no stable boundary in
    common, and whole as a last resort: where the overlap reaches back to the last joint, or
    where the pieces do not spell the text's bytes.

    Null texts count as empty and have no tokens. Null ids and repeated rows pass
    through, an empty table gives no rows, other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        counter = ChunkedCounter(path, chunk, overlap)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = np.zeros(len(texts), np.int64)
            group: list[int] = []
            held = 0

            def encode(rows: list[int]) -> None:
                found = counter.model.encode([texts[i].as_py() for i in rows], num_threads=1)
                tokens[rows] = [len(ids) for ids in found]

            for i, length in enumerate(lengths):
                if length > counter.chunk:
                    tokens[i] = counter.count(texts[i].as_py())
                    continue
                group.append(i)
                held += int(length)
                if held >= BATCH_BYTES:
                    encode(group)
                    group, held = [], 0
            if group:
                encode(group)
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(lengths), pa.array(tokens)],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    result = docs.select("doc_id", "text").mapInArrow(
        counted, f"doc_id {id_type}, n_bytes long, n_tokens long"
    )
    return result.withColumn("over_limit", F.col("n_tokens") > limit)
