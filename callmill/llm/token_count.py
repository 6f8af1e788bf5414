"""Token counts by byte-pair merging with a heap and a linked list.

A text's symbols start as its characters. The adjacent pair whose joined piece has the lowest rank is popped from the heap and
merged, the pairs with its new neighbours are pushed, and so on until no pair is a piece. The count is the initial
symbols less the merges, where a character without a piece of its own starts as its UTF-8 bytes; no ids are made.

Two neighbouring characters that stand next to each other in no piece can never be merged across. Texts are
cut there, so that equal words are merged once per task and looked up afterwards. The lookup is bounded; it
only saves time.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import prepare, text_of

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED = 400_000


class Pieces:
    """Ranks of a sentencepiece BPE model's pieces, and the counting of texts with them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalise = model.normalize
        normal = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        # The highest score is merged first; equal scores take the leftmost, as everywhere.
        order = sorted(normal, key=lambda i: -model.get_score(i))
        self.rank: dict[str, int] = {}
        last, rank = None, -1
        for i in order:
            if model.get_score(i) != last:
                last, rank = model.get_score(i), rank + 1
            self.rank[model.id_to_piece(i)] = rank
        self.joined = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        # Where a space sign follows any other character inside a piece, words could not be told apart.
        if any(pair[1] == SPACE != pair[0] for pair in self.joined):
            raise ValueError(f"{path}: pieces run across words")
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for word in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", self.normalise(text)):
            n = known.get(word)
            if n is None:
                n = self._word(word)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(word) < 64:
                    known[word] = n
            total += n
        return total

    def _word(self, word: str) -> int:
        """Cut between characters that no piece joins, then merge each part."""
        joined, known = self.joined, self.known
        total, start = 0, 0
        for i in range(1, len(word) + 1):
            if i == len(word) or word[i - 1 : i + 1] not in joined:
                part = word[start:i]
                start = i
                n = known.get(part)
                if n is None:
                    n = self.merged(part)
                    if len(part) < 64:
                        known[part] = n
                total += n
        return total

    def merged(self, part: str) -> int:
        """Initial symbols less merges."""
        get, n = self.rank.get, len(part)
        count = sum(1 if c in self.rank else len(c.encode()) for c in part)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(part[i : i + 2])) is not None]
        if not heap:
            return count
        heapify(heap)
        # The symbol at i reaches to end[i]; before[i] is where the symbol on its left starts; -1 marks a symbol
        # that has been merged into its left neighbour.
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            _, i, until = heappop(heap)
            middle = end[i]
            if middle < 0 or middle >= n or end[middle] != until:
                continue  # one of the two has been merged since
            end[i], end[middle] = until, -1
            count -= 1
            if until < n:
                before[until] = i
                if (r := get(part[i : end[until]])) is not None:
                    heappush(heap, (r, i, end[until]))
            left = before[i]
            if left >= 0 and (r := get(part[left:until])) is not None:
                heappush(heap, (r, left, until))
        return count


_LOADED: dict[str, Pieces] = {}


def _pieces(shipped: str | None) -> Pieces:
    """One model per worker process: the file that Spark ships, or the installed one."""
    import public_tokenizers

    path = SparkFiles.get(shipped) if shipped else public_tokenizers.path(MODEL)
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Whole texts are counted, without begin and end tokens; special strings in them are ordinary text. Null texts count as
    empty: 0 bytes, 0 tokens. Repeated rows each keep their row, an empty table gives none, other columns
    are ignored. Without `model_path` each worker takes the installed model; a given file is shipped to them.
    """
    spark = prepare(docs.sparkSession)
    if model_path:
        spark.sparkContext.addFile(model_path)
    shipped = os.path.basename(model_path) if model_path else None

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shipped)
        for batch in batches:
            n = [pieces.count(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        text_of().alias("_text"),
    )
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
