"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Every document is tokenised, closed with an end id and cut into pieces.  The
pieces of a block of documents are divided among ``k`` sequences, ``k`` being the
block's tokens over the capacity, rounded up: each piece starts as a partition
of its own with one part; the two partitions with the largest spread (largest
part less smallest part) are merged again and again, the fullest part of one
with the emptiest of the other, until one partition is left, whose parts are
nearly equal.  If the fullest part exceeds the capacity, ``k`` rises and the
block is divided anew.

Cuts: a document gives as many whole sequences as it fills and the rest is cut
at ``max_piece``, so that every block has enough small pieces for the parts to
come out level.  Blocks are formed inside the input partitions and hold about
``block_sequences`` sequences, so memory is bounded and nothing is shuffled.

The ids are those of the given tokenizer file, without special tokens added.
A byte-level BPE file whose merge order is its id order is run through the
faster rank encoder of ``tiktoken`` (same vocabulary, same split pattern, same
ids); any other file goes through ``tokenizers`` itself.

Defined cases: a null or empty text has the end id alone; a special token's
string in a text gives that token's id, as the tokenizer file says; a null id
is packed like any other; repeated rows are packed one by one; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import id_text

CAPACITY = 2048
END_ID = 1
MAX_PIECE = 512
BLOCK_SEQUENCES = 128
#: the split pattern of byte-level BPE (fixed value), with possessive repeats
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
)


def default_tokenizer() -> str:
    """The byte-level BPE file of the installed vocabularies (a path on every machine)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes and ids, if the file is plain byte-level BPE whose merges come in id order."""
    model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab, byte = model["vocab"], _byte_of()
    merged = [vocab[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)) or any(c not in byte for t in vocab if t not in special for c in t):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
    single = sum(len(t) == 1 for t in ranks)
    return ranks if single == 256 and len(ranks) == 256 + len(merged) else None


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to its ids, for the tokenizer file at ``path`` on this machine."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = _ranks(spec)
    added = spec.get("added_tokens", [])
    if ranks and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        import tiktoken

        special = {t["content"]: t["id"] for t in added}
        enc = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> np.ndarray:
            if any(s in text for s in special):
                return enc.encode_to_numpy(text, allowed_special="all")
            return enc.encode_to_numpy(text, disallowed_special=())

        return encode
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """``sizes`` divided into ``k`` nearly equal parts: the numbers of each part's pieces."""
    if k == 1:
        return [list(range(len(sizes)))]
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [(size, [i])]))  # a partition lists its parts that hold anything, fullest first
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # fullest of a to emptiest of b: place j of a meets place k - 1 - j of b
        merged = list(a[: max(0, k - len(b))])
        merged += b[: max(0, k - len(a))]
        for j in range(max(0, k - len(b)), len(a)):
            x, y = a[j], b[k - 1 - j]
            merged.append((x[0] + y[0], x[1] + y[1]))
        merged.sort(key=lambda part: -part[0])
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (low - merged[0][0], serial, merged))
        serial += 1
    parts = [items for _, items in heap[0][2]] if heap else []
    return parts


def divide(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few parts as differencing fits under the capacity: their number rises while one exceeds it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = difference(sizes, k)
        if max((sum(sizes[i] for i in p) for p in parts), default=0) <= capacity:
            return parts
        k += 1


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    max_piece: int = MAX_PIECE,
    block_sequences: int = BLOCK_SEQUENCES,
) -> DataFrame:
    """One row per piece (``SCHEMA``); a sequence's pieces lie gapless from offset 0.

    ``sequence_id`` is the input partition's number times 2**33 plus a count
    within it, so a task that runs again gives the same rows."""
    limit = capacity * block_sequences

    def pieces(doc_id, ids: np.ndarray) -> Iterator[tuple]:
        total = len(ids)
        whole = total // capacity * capacity
        cuts = [*range(0, whole, capacity)]
        rest = total - whole
        if rest:
            parts = -(-rest // max_piece)
            cuts += [whole + rest * j // parts for j in range(parts)]
        for start, end in zip(cuts, [*cuts[1:], total], strict=True):
            yield doc_id, start, end - start, zlib.crc32(ids[start:end].tobytes()), total

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        out: list[tuple] = []
        block: list[tuple] = []
        held = 0

        def close() -> None:
            nonlocal number, block, held
            for part in divide([p[2] for p in block], capacity):
                offset = 0
                length = sum(block[i][2] for i in part)
                for i in part:
                    out.append((*block[i], number, offset, length))
                    offset += block[i][2]
                number += 1
            block, held = [], 0

        def drained() -> pd.DataFrame:
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"doc_id": "Int64"})
            out.clear()
            return frame

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = np.append(encode(text), end_id).astype("<u4")
                for p in pieces(None if pd.isna(doc_id) else int(doc_id), ids):
                    if p[2] == capacity:
                        out.append((*p, number, 0, capacity))
                        number += 1
                    else:
                        block.append(p)
                        held += p[2]
                if held >= limit:
                    close()
                if len(out) >= 20_000:
                    yield drained()
        if block:
            close()
        if out:
            yield drained()

    return id_text(docs, id_col, text_col).mapInPandas(run, SCHEMA)
