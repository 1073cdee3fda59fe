"""Token counts by rank-synchronous merging of ragged arrays (op 7).

Distinct pre-tokens of a batch are held as one flat array of symbols with
their row limits.  In each round every sequence finds the lowest rank among
its adjacent pairs and applies all merges of that pair at once, left to
right; sequences without a pair that merges leave.  What survives is counted.

Cases: a null or empty text has no bytes and no tokens; a special string in a
text counts one token, as the library's default has it; rows are independent,
so repeats, ties and other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame

from propensa.llm.arrow import field_type, slices, text_of
from propensa.llm.tokenizer import BYTE_WORDS, OTHER, Generations, byte_alphabet

#: The public byte-level word pattern, for texts outside the fast alphabet.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NEVER = np.int64(1 << 40)
#: Symbols merged at once; longer batches are worked off in parts.
PART_SYMBOLS = 2_000_000


class MergeTable:
    """Ranks of symbol pairs and the symbols they merge to."""

    def __init__(self, path: str):
        config = json.loads(open(path, encoding="utf-8").read())
        vocab = config["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in config["model"]["merges"]]
        self.size = np.int64(len(vocab) + 1)
        self.of_byte = np.array([vocab[c] for _, c in sorted(byte_alphabet().items())], np.int64)
        keys = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in merges], np.int64)
        self.rank = np.argsort(keys, kind="stable").astype(np.int64)
        self.keys = keys[self.rank]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        special = [t["content"] for t in config["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.counts = Generations()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER)

    def surviving(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word after all merges."""
        lengths = np.array([len(w) for w in words], np.int64)
        left = lengths.copy()
        flat = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        row = np.repeat(np.arange(len(words)), lengths)
        while len(flat) > 1:
            # rank of the pair that starts at each symbol; none across rows
            rank = np.full(len(flat), NEVER)
            inside = row[1:] == row[:-1]
            rank[:-1][inside] = self.ranks(flat[:-1][inside], flat[1:][inside])
            first = np.flatnonzero(np.concatenate([[True], ~inside]))
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(flat)))
            best = np.repeat(lowest, sizes)
            hit = (rank == best) & (best < NEVER)
            # in a run of overlapping hits (a a a ...) every other one counts
            at = np.flatnonzero(hit)
            if not len(at):
                break
            start = np.concatenate([[True], np.diff(at) > 1])
            in_run = np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
            at = at[in_run % 2 == 0]
            flat[at] = self.made[rank[at]]
            left -= np.bincount(row[at], minlength=len(left))
            keep = best < NEVER
            keep[at + 1] = False
            flat, row = flat[keep], row[keep]
        return left

    def learn(self, words: set[str]) -> None:
        """Count the words that are not known yet."""
        self.counts.turn()
        new = self.counts.unknown(words)
        part: list[bytes] = []
        size, start = 0, 0
        for i, word in enumerate(new):
            part.append(word.encode())
            size += len(part[-1])
            if size >= PART_SYMBOLS or i + 1 == len(new):
                self.counts.update(zip(new[start:i + 1], self.surviving(part).tolist()))
                part, size, start = [], 0, i + 1

    def count(self, texts: list[str]) -> list[int]:
        extra = [0] * len(texts)
        split = []
        for i, text in enumerate(texts):
            pieces = [text]
            if self.special is not None and self.special.search(text):
                pieces = self.special.split(text)
                extra[i] = len(pieces) - 1
            split.append([w for p in pieces for w in (WORDS if OTHER.search(p) else BYTE_WORDS).findall(p)])
        self.learn(set().union(*split))
        get = self.counts.__getitem__
        return [n + sum(map(get, words)) for n, words in zip(extra, split)]


@functools.lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row of ``docs``."""
    table = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = merge_table(path)
        for batch in batches:
            for rows, texts in slices(batch):
                size = pa.compute.binary_length(rows.column("text")).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), size, pa.array(tokens.count(texts), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    return table.mapInArrow(count, f"doc_id {field_type(table, 'doc_id')}, n_bytes bigint, n_tokens bigint")
