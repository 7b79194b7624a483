"""Token counts of byte-level BPE vocabularies, without making the tokens."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How byte-level vocabularies cut text into pieces (fixed value).
PIECES = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
MAX_FILE_BYTES = 64 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


@dataclass
class Merges:
    """Merge ranks of a vocabulary. Symbols are numbers: 0 to 255 for bytes, then 256 + rank."""

    ranks: dict[int, int]
    specials: list[str]
    # Counts of pieces seen by this process; emptied when full, so memory is bounded.
    known: dict[str, int] = field(default_factory=dict)
    most_known: int = 400_000

    @classmethod
    def load(cls, path: str) -> Merges:
        """Read a tokenizer file with a byte-level BPE model and nothing that alters text."""
        with open(path, encoding="utf-8") as file:
            text = file.read(MAX_FILE_BYTES + 1)
        if len(text) > MAX_FILE_BYTES:
            raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
        whole = json.loads(text)
        model, before = whole["model"], whole["pre_tokenizer"]
        plain = (
            model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
            and whole["normalizer"] is None and before["type"] == "ByteLevel"
            and before["use_regex"] and not before["add_prefix_space"]
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"]
                        for t in whole["added_tokens"])
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        symbols = {letter: byte for byte, letter in enumerate(byte_letters())}
        ranks = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks[symbols[left] << 32 | symbols[right]] = rank
            symbols[left + right] = 256 + rank
        return cls(ranks, [t["content"] for t in whole["added_tokens"]])

    def count_piece(self, piece: bytes) -> int:
        """Initial symbols minus merges, the pair of lowest rank (then leftmost) first.

        Symbols form a linked list; the heap holds rank and place of adjacent
        pairs. Entries gone stale by a merge next to them are skipped when they
        come up. A piece of n bytes takes O(n log n).
        """
        n = len(piece)
        ranks = self.ranks
        symbol = list(piece)
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbol[i] << 32 | symbol[i + 1])
            if rank is not None:
                heap.append(rank << 32 | i)
        if not heap:
            return n
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        count = n
        while heap:
            top = heapq.heappop(heap)
            i, rank = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if j >= n or symbol[i] < 0 or ranks.get(symbol[i] << 32 | symbol[j]) != rank:
                continue
            symbol[i], symbol[j] = 256 + rank, -1
            k = after[i] = after[j]
            count -= 1
            if k < n:
                before[k] = i
                rank = ranks.get(symbol[i] << 32 | symbol[k])
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = ranks.get(symbol[h] << 32 | symbol[i])
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | h)
        return count

    def _new_piece(self, piece: str) -> int:
        count = self.count_piece(piece.encode())
        if len(piece) <= 40:
            if len(self.known) >= self.most_known:
                self.known.clear()
            self.known[piece] = count
        return count

    def count(self, text: str) -> int:
        """Tokens of a text; special strings in it are one token each."""
        if not self.specials:
            return self._count_plain(text)
        # Longest first: of two that start at a place, the longer one counts.
        pattern = "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))
        parts = re.split(pattern, text)
        return len(parts) - 1 + sum(map(self._count_plain, parts))

    def _count_plain(self, text: str) -> int:
        known, total = self.known, 0
        for found in _PATTERN.finditer(text):
            piece = found.group()
            count = known.get(piece)
            total += self._new_piece(piece) if count is None else count
        return total


_PATTERN = regex.compile(PIECES)
# Vocabularies this process has built, by file; workers serve many tasks.
_BUILT: dict[str, Merges] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row, one pass, no shuffle.

    ``path`` names a tokenizer file that the driver reads; its merges (at most
    ``MAX_FILE_BYTES``) are broadcast. Null and empty texts have no bytes and no
    tokens. Rows are independent of each other, repeated ones stay repeated.
    """
    merges = Merges.load(path)
    shared = docs.sparkSession.sparkContext.broadcast((merges.ranks, merges.specials))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _BUILT:
            _BUILT[path] = Merges(*shared.value)
        counter = _BUILT[path]
        for batch in batches:
            tokens = [counter.count(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.int64()), batch.column(2)],
                ["doc_id", "n_tokens", "n_bytes"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    counted = docs.select(
        F.col(doc_id).alias("doc_id"), body.alias("_body"),
        F.octet_length(body).cast("long").alias("n_bytes"),
    ).mapInArrow(of_batches, f"doc_id {kind}, n_tokens bigint, n_bytes bigint")
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
