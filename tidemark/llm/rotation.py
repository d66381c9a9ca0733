"""Fill-in-the-middle by in-place block rotation.

A text is scanned into units, runs of ASCII letters and single other characters, on
its UTF-8 bytes. Two cuts between units part it into prefix, middle and suffix. The
sentinels are inserted into one bytearray, in front of their segments,

    <P> prefix <M> middle <S> suffix

and the segments change places by a rotation: each of two neighbouring blocks is
reversed, then both together. ``psm`` exchanges middle and suffix, ``spm`` moves the
suffix to the front. The inverse finds the sentinels, rotates the same blocks back and
takes the sentinels out. A text that holds a sentinel stays as it is, so a sentinel in
an output is always one that was inserted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
# Of a hundred texts, how many are rotated, and of a hundred of those, how many as spm.
RATE, SPM = 90, 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
# Bytes that go on with a character.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x80:0xC0] = True


def unit_starts(data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Offsets of the bytes that start a unit; ``firsts`` are the first bytes of non-empty texts."""
    letter = _LETTER[data]
    starts = ~_INSIDE[data]
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[firsts] = True
    return np.flatnonzero(starts)


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four numbers that depend on the id alone; no id draws as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def _exchange(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Swap the neighbouring blocks [start, middle) and [middle, end) by three reversals."""
    for a, b in ((start, middle), (middle, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1]


def rotate(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The output of a text cut at two byte offsets, first <= second."""
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle = len(PREFIX) + first
    suffix = middle + len(MIDDLE) + second - first
    _exchange(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def restore(output: bytes, form: str) -> bytearray:
    """The text that :func:`rotate` got; needs the output and its form only."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    start = buffer.find(SUFFIX)
    _exchange(buffer, start, buffer.find(MIDDLE if form == "psm" else PREFIX, start), len(buffer))
    middle = buffer.find(MIDDLE)
    suffix = buffer.find(SUFFIX, middle)
    del buffer[suffix : suffix + len(SUFFIX)]
    del buffer[middle : middle + len(MIDDLE)]
    del buffer[: len(PREFIX)]
    return buffer


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def rotated(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``n`` counts units. Cuts and form follow from the id, so reruns agree and rows
    that share an id are cut by the same draws; cuts that meet leave an empty middle.
    Null texts count as empty; empty texts and those that hold a sentinel are plain,
    their output is the text and their lengths are null. Very long texts are taken
    whole, one at a time. An empty table gives an empty one; other columns aren't read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _bytes_of(batch.column("text"))
            ends = np.cumsum([len(text) for text in texts])
            firsts = ends - [len(text) for text in texts]
            data = np.frombuffer(b"".join(texts), np.uint8)
            units = unit_starts(data, firsts[firsts < ends])
            before = np.searchsorted(units, np.append(firsts, len(data)))
            counts, forms, prefixes, middles, outputs = np.diff(before), [], [], [], []
            for k, (doc_id, text, n) in enumerate(zip(batch.column("doc_id").to_pylist(), texts, counts.tolist(), strict=True)):
                h1, h2, h3, h4 = draws(doc_id, seed)
                if not text or h3 % 100 >= rate or any(sentinel in text for sentinel in (PREFIX, SUFFIX, MIDDLE)):
                    forms.append("plain")
                    prefixes.append(None)
                    middles.append(None)
                    outputs.append(text)
                    continue
                start, end = int(firsts[k]), int(ends[k])
                cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
                first, second = (int(units[before[k] + cut]) if cut < n else end for cut in cuts)
                forms.append("spm" if h4 % 100 < spm else "psm")
                prefixes.append(first - start - int(_INSIDE[data[start:first]].sum()))
                middles.append(second - first - int(_INSIDE[data[first:second]].sum()))
                outputs.append(bytes(rotate(text, first - start, second - start, forms[-1])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(forms, pa.string()),
                    pa.array(prefixes, pa.int64()),
                    pa.array(middles, pa.int64()),
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restored(outputs: DataFrame) -> DataFrame:
    """Add ``text``, rebuilt from ``output`` and ``form`` alone; a null output is empty.

    ``text`` must not be a column yet.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            forms = batch.column("form").to_pylist()
            texts = [bytes(restore(o, f)) for o, f in zip(_bytes_of(batch.column("output")), forms, strict=True)]
            names = [*batch.schema.names, "text"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return outputs.mapInArrow(run, f"{fields}, text string")


def digests(docs: DataFrame) -> DataFrame:
    """What :func:`rotated` says of every row, with digests of its output and of the text restored from it."""
    both = restored(rotated(docs))
    return both.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = rf"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t FROM documents
), drawn AS (
  SELECT *, len(t) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(t) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(t) + 1) AS c2,
         CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM units
), formed AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= {RATE} THEN 'plain'
                 WHEN h4 < {SPM} THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(t[1:least(c1, c2)], '') AS p, array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(t[greatest(c1, c2) + 1:], '') AS s FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""
