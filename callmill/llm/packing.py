"""Packing of token sequences by sums of squares.

Texts become token ids, longer ones are cut into full pieces, and the pieces are dealt into sequences: each piece, longest
first, goes to the open sequence for which the sum over all gaps of the squared number of open sequences with that gap
becomes smallest, the tightest of equals; a new sequence is opened where none has room. The state of a packer is one
count per gap, whatever the number of documents.

Packers work on blocks of a bounded number of pieces in parallel. What they leave in poorly filled sequences is taken out
and dealt anew together with that of the other blocks, until one block is left.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import holds_lookups, prepare, saved, text_of

MODEL = "word_bpe_49k.json"
LENGTH = 4096
END = (1).to_bytes(4, "little")
REMEMBERED = 600_000
# Pieces that one packer places, and the fill (of LENGTH) below which a sequence is taken apart and dealt anew.
BLOCK_PIECES = 10_000
REOPEN_BELOW = 0.98

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Bytes that are neither blanks, letters nor digits; of characters beyond ASCII only the last byte is looked at, and counts.
_OTHER = np.array([not (chr(b).isalnum() or b in b" \n\t\r") if b < 0x80 else True for b in range(256)])

# Signs that a word may end with; an apostrophe is none, as the tokenizer's pattern has rules of its own for it.
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")

# The settings of a tokenizer file that `Ids` knows how to take apart.
_KNOWN_SETTINGS = {
    "truncation": None,
    "padding": None,
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}


def _as_bytes(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


class WholeTexts:
    """Token ids of texts as little-endian 32-bit bytes, by the library alone."""

    def __init__(self, settings: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(settings)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def forget(self) -> None:
        """The library's own lookup is bounded."""

    def of(self, texts: list[str]) -> list[bytes]:
        return [_as_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Ids:
    """The same for a tokenizer of _KNOWN_SETTINGS, from the ids of stretches met before.

    The tokenizer's pattern never joins characters across blanks or line ends and leaves those out, so the ids of a text are
    those of the stretches between them. It never joins letters with other signs either: where no comma or full stop
    stands behind another sign, those before a blank are stretches of their own. Case is ignored, which is
    settled here for plain ASCII.

    Special strings are looked for in the text as it is given, before its case is: a tokenizer without them does the rest.

    Stretches met before are looked up, among recent ones first and then among older ones, which are forgotten
    in time. That only saves time. A new word goes to the merges directly, without the search for what is a word.
    """

    def __init__(self, settings: str):
        from tokenizers import Tokenizer, pre_tokenizers

        made = json.loads(settings)
        self.special = {t["content"]: _as_bytes([t["id"]]) for t in made["added_tokens"]}
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(self.special, key=len, reverse=True)))})")
        self.tokenizer = Tokenizer.from_str(json.dumps({**made, "added_tokens": []}))
        self.model = self.tokenizer.model
        # The characters that stand for bytes, as the library has them.
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {}
        for point in (*range(0x800), *range(0x1000, 0xD000, 0x1000), 0xE000, 0xF000, *range(0x10000, 0x110000, 0x40000)):
            raw = chr(point).encode()
            self.letters.update(zip(raw, byte_level.pre_tokenize_str(chr(point))[0][0]))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def fits(settings: str) -> bool:
        made = json.loads(settings)
        model = made["model"]
        return (
            all(made.get(k) == v for k, v in _KNOWN_SETTINGS.items())
            and (model["type"], model.get("dropout"), model.get("byte_fallback")) == ("BPE", None, False)
            and bool(made["added_tokens"])
            and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in made["added_tokens"])
        )

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [_as_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _stretches(self, text: str) -> list[str]:
        plain = text.isascii()
        data = np.frombuffer(text.encode(), np.uint8)
        text = (text.lower() if plain else text).replace("\n", " ").replace("\t", " ").replace("\r", " ")
        signs = (data[1:] == 0x2C) | (data[1:] == 0x2E)
        if not (signs & _OTHER[data[:-1]]).any():
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def of(self, texts: list[str]) -> list[bytes]:
        parts, owners = [], []
        for row, text in enumerate(texts):
            some = self.split.split(text) if any(s in text for s in self.special) else [text]
            parts.extend(some)
            owners.extend([row] * len(some))
        found = self._of_parts(parts)
        if len(parts) == len(texts):
            return found
        joined = [b""] * len(texts)
        for row, ids in zip(owners, found):
            joined[row] += ids
        return joined

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {"": b""}
        known, older = self.known, self.older
        split = [[] if t in self.special else self._stretches(t) for t in parts]
        missing = set().union(*split).difference(known)
        if older:
            known.update({w: older[w] for w in missing if w in older})
            missing.difference_update(known)
        own = self._learn(missing)
        get = (lambda w: known[w] if w in known else own[w]) if own else known.__getitem__
        return [self.special[t] if t in self.special else b"".join(map(get, words)) for t, words in zip(parts, split)]

    def _word(self, letters: str) -> bytes | None:
        """The ids of letters alone; None where normal forms or odd cases may matter."""
        if not letters.isalpha():
            return None
        lowered = letters.lower()
        if not letters.isascii():
            if max(letters) >= "\u0250" or not lowered.isalpha():
                return None
            lowered = lowered.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(lowered)]).tobytes()

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """Put stretches into the lookup; long ones, which hardly come again, are returned instead."""
        known, own, rest = self.known, {}, []
        tails: dict[str, bytes] = {"": b""}
        for word in missing:
            letters = word.rstrip(_SIGNS)
            ids = self._word(letters) if letters and len(word) < 64 else None
            if ids is None:
                rest.append(word)
                continue
            tail = word[len(letters) :]
            if tail not in tails:
                tails[tail] = self._encoded([tail])[0]
            known[word] = ids + tails[tail]
        for i in range(0, len(rest), 10_000):
            some = rest[i : i + 10_000]
            for word, ids in zip(some, self._encoded(some)):
                (known if len(word) < 64 else own)[word] = ids
        return own


_LOADED: dict[str, Ids | WholeTexts] = {}


def _forget() -> None:
    for ids in _LOADED.values():
        ids.forget()


def _ids(shipped: str | None) -> Ids | WholeTexts:
    import public_tokenizers

    holds_lookups("packing", _forget)
    path = SparkFiles.get(shipped) if shipped else public_tokenizers.path(MODEL)
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            settings = file.read()
        _LOADED[path] = Ids(settings) if Ids.fits(settings) else WholeTexts(settings)
    return _LOADED[path]


def pieces(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH) -> DataFrame:
    """PIECES of every document: its ids and an end id, cut after every `length`.

    Special strings of the tokenizer inside a text get their ids, as the library has it by default."""
    spark = prepare(docs.sparkSession)
    if tokenizer_path:
        spark.sparkContext.addFile(tokenizer_path)
    shipped = os.path.basename(tokenizer_path) if tokenizer_path else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(shipped)
        for batch in batches:
            row, piece, start, size, crc = [], [], [], [], []
            for r, found in enumerate(ids.of(batch.column("_text").to_pylist())):
                whole = found + END
                for k, a in enumerate(range(0, len(whole), 4 * length)):
                    part = whole[a : a + 4 * length]
                    row.append(r)
                    piece.append(k)
                    start.append(a // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text")).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; sequences are numbered from 0."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    # counts[g]: open sequences with gap g. A full sequence is closed: it adds no square.
    counts = np.zeros(capacity + 1, np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        here = counts[s:capacity]
        room = np.flatnonzero(here)
        if len(room):
            # Moving from gap g to g - s changes the sum by 2 (counts[g - s] - counts[g]) + 2, or
            # by 1 - 2 counts[g] where g = s.
            change = 2 * (counts[room] - here[room]) + 2
            if room[0] == 0:
                change[0] = 1 - 2 * here[0]
            gap = s + int(room[np.argmin(change)])
            counts[gap] -= 1
            at = open_[gap].pop()
        else:
            gap, at, made = capacity, made, made + 1
        sequence[i], offset[i] = at, capacity - gap
        if gap > s:
            counts[gap - s] += 1
            open_[gap - s].append(at)
    return sequence, offset


def pack(cut: DataFrame, length: int = LENGTH, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """`cut` (PIECES) with sequence_id and offset."""
    spark = cut.sparkSession
    # A number for each row, fixed by writing it: repeated rows and ids are different pieces.
    waiting = saved(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    names = waiting.columns
    done = None
    for turn in range(100):
        n = waiting.count()
        blocks = -(-n // block_pieces)
        last = blocks <= 1

        def place(keys, rows):
            order = np.argsort(rows.column("_row").to_numpy(), kind="stable")  # as Spark's order of rows may change
            rows = rows.take(pa.array(order))
            size = rows.column("length").to_numpy()
            sequence, offset = sum_of_squares(size, length)
            fill = np.bincount(sequence, weights=size, minlength=1)
            final = np.full(len(size), True) if last else fill[sequence] >= REOPEN_BELOW * length
            first = (turn << 56) + (int(keys[0].as_py()) << 20)
            return (
                rows.select(names)
                .append_column("sequence_id", pa.array(first + sequence, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64()))
                .append_column("_final", pa.array(final))
            )

        schema = f"{PIECES}, _row long, sequence_id long, offset long, _final boolean"
        # Dealt round by row number, so that no block outgrows a task, whatever the ids are.
        block = F.pmod(F.xxhash64("_row"), F.lit(max(blocks, 1)))
        placed = saved(waiting.withColumn("_block", block).groupBy("_block").applyInArrow(place, schema), "placed")
        part = placed.filter("_final").drop("_final", "_row")
        done = part if done is None else done.unionByName(part)
        if last:
            return done
        left = placed.filter("NOT _final").select(names)
        # A round that can't close anything more would not end: what is left then is as packed as it gets.
        if left.count() >= n:
            return done.unionByName(placed.filter("NOT _final").drop("_final", "_row"))
        waiting = left
    return done.unionByName(placed.filter("NOT _final").drop("_final", "_row"))


def pack_documents(
    docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH, block_pieces: int = BLOCK_PIECES
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most `length` tokens and are gapless from offset 0. A null or empty text is one piece that holds the
    end id alone. Repeated rows and repeated ids are packed once per row. An empty table gives no rows; other columns
    are ignored.
    """
    return pack(pieces(docs, tokenizer_path, length), length, block_pieces)
