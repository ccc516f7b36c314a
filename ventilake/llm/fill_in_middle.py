"""Fill-in-middle transformation by in-place rotation of blocks.

A text is cut at line ends into prefix, middle and suffix.  Sentinels are put
in front of the three blocks inside one bytearray, and the blocks are exchanged
where they are: two neighbouring segments change places when each of them and
then both together are reversed.

- psm: middle and suffix change places: ``<P>prefix<S>suffix<M>middle``;
- spm: prefix with middle and suffix change places: ``<S>suffix<P>prefix<M>middle``;
- plain: the text itself, where it is empty or holds a sentinel (or, with a
  ``rate`` below 100, by chance).

``restore`` needs the output and its form only: it finds the sentinels, which no
transformed text holds itself, rotates the blocks back and takes them out.

Units are ``[^\\n]*\\n|[^\\n]+``.  The cuts are chosen by the sha256 of
``<seed>:<doc_id>``, so they do not depend on partitioning or retries.

Defined cases: null text counts as empty (no units, plain, empty output); a null
id is written as nothing (``<seed>:``); the three blocks may be empty; rows that
repeat an id are cut by the same digits, each in its own text; the order of rows
plays no part; texts of any length take a few copies of themselves; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import id_text

SEED = 7
#: percent of the texts that are transformed, and percent of these in the form spm
RATE = 100
SPM = 50
PREFIX, SUFFIX, MIDDLE = SENTINELS = (b"<P>", b"<S>", b"<M>")
_WIDE = len(PREFIX)


def reverse(buffer: bytearray, start: int, end: int) -> None:
    buffer[start:end] = buffer[start:end][::-1]


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Let the segments ``start:cut`` and ``cut:end`` change places, by three reversals."""
    reverse(buffer, start, cut)
    reverse(buffer, cut, end)
    reverse(buffer, start, end)


def unit_ends(data: bytes | bytearray) -> np.ndarray:
    """Where the units end, in bytes."""
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    return ends if not data or data.endswith(b"\n") else np.append(ends, len(data))


def form_of(data: bytes, h3: int, h4: int, rate: int = RATE, spm: int = SPM) -> str:
    if not data or any(s in data for s in SENTINELS) or h3 % 100 >= rate:
        return "plain"
    return "spm" if h4 % 100 < spm else "psm"


def transform(data: bytes, form: str, cut: int, end: int) -> bytearray:
    """The output for a text whose prefix ends at byte ``cut`` and whose middle ends at ``end``."""
    buffer = bytearray(data)
    if form == "plain":
        return buffer
    buffer[end:end] = SUFFIX
    buffer[cut:cut] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = cut + _WIDE, end + 2 * _WIDE
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def restore(output: bytes, form: str) -> bytearray:
    """The text that ``transform`` was given."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    size = len(buffer)
    # the second segment of the rotation came first: after the way back it is as long as before
    start, cut = (buffer.find(SUFFIX), buffer.find(MIDDLE)) if form == "psm" else (0, buffer.find(PREFIX))
    rotate(buffer, start, cut, size)
    suffix = start + size - cut
    middle = start if form == "psm" else buffer.find(MIDDLE)
    del buffer[suffix : suffix + _WIDE]
    del buffer[middle : middle + _WIDE]
    del buffer[:_WIDE]
    return buffer


def _chars(data: bytes) -> int:
    """Code points of UTF-8 text: its bytes but for continuation bytes."""
    return int(np.count_nonzero(np.frombuffer(data, dtype=np.uint8) & 0xC0 != 0x80))


def draws(doc_id: Column, seed: int = SEED) -> Column:
    """The first four unsigned 32-bit numbers of the sha256 of ``<seed>:<doc_id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM
) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts units; the two lengths are code points, null for plain rows."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, (h1, h2, h3, h4) in zip(frame["doc_id"], frame["text"], frame["draws"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                ends = unit_ends(data)
                n = len(ends)
                form = form_of(data, int(h3), int(h4), rate, spm)
                if form == "plain":
                    out.append((doc_id, n, form, None, None, text))
                    continue
                at = sorted((int(h1) % (n + 1), int(h2) % (n + 1)))
                cut, end = (int(ends[k - 1]) if k else 0 for k in at)
                output = transform(data, form, cut, end).decode("utf-8", "surrogatepass")
                out.append((doc_id, n, form, _chars(data[:cut]), _chars(data[cut:end]), output))
            columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
            numbers = {"doc_id": "Int64", "n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"}
            yield pd.DataFrame(out, columns=columns).astype(numbers)

    rows = id_text(docs, id_col, text_col).withColumn("draws", draws(F.col("doc_id"), seed))
    return rows.mapInPandas(build, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The texts again, from the columns of output and form alone."""

    @F.pandas_udf("string")
    def rebuild(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        pairs = zip(outputs, forms, strict=True)
        texts = [restore(o.encode("utf-8", "surrogatepass"), f).decode("utf-8", "surrogatepass") for o, f in pairs]
        return pd.Series(texts, dtype=object)

    return rebuild(output, form)
