"""SimHash near-duplicates: fingerprints of whole texts, linked by pigeonring filtering.

A fingerprint is cut into ``max_distance + 1`` segments, taken as a ring. If two
fingerprints differ in at most ``max_distance`` bits, some segment starts a chain of
which the first segment is equal, the first two differ in at most one bit, the first
three in at most two, and so on round the ring. The first two segments form the join
key: one side is stored as it is, the other also with each bit of the second segment
set, so the join meets only fingerprints whose chain of two fits. The longer chains
are then checked bit by bit, and the full distance last.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import same_key, slices, text_key, texts_of
from tidemark.llm.components import components
from tidemark.sources import stored

WIDTH = 3
MAX_DISTANCE = 2
SEED = 42
BITS = 64
# Shingles whose bits are unpacked at once, 64 bytes each.
TILE = 1 << 16


def fingerprint(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """The SimHash of a text as a signed 64-bit number; 0 for a text without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII blanks part
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: 1 - width or None], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(starts))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), TILE):
        octets = hashes[at : at + TILE].astype("<u8").view(np.uint8)
        counts += np.unpackbits(octets, bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprint(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text_key, fingerprint) of every document; null text counts as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(text, width) for text in texts_of(batch)]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fingerprint"])

    narrow = docs.select("doc_id", text_key().alias("text_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, text_key bigint, fingerprint bigint")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def segments(max_distance: int) -> list[int]:
    """Bit masks of the segments of the ring."""
    count = max_distance + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def link_fingerprints(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b) for all different fingerprints at ``max_distance`` bits or fewer.

    ``prints`` has the distinct values in ``fingerprint``. A pair can appear more
    than once. Per fingerprint the join reads ``max_distance + 1`` stored rows and
    about 35 probes for two bits, whatever the size of the table; what a key
    gathers is bounded by the fingerprints that agree in two whole segments.
    """
    if max_distance < 1:
        return prints.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    ring = segments(max_distance)
    count = len(ring)
    chains = []
    for start in range(count):
        mask, masks = 0, []
        for step in range(count):
            mask |= ring[(start + step) % count]
            masks.append(mask)
        chains.append(masks)
    flips = [
        (start, _signed(chains[start][1]), _signed(1 << bit) if bit is not None else 0)
        for start in range(count)
        for bit in [None, *(b for b in range(BITS) if ring[(start + 1) % count] >> b & 1)]
    ]
    probe = F.array(*[F.struct(F.lit(s).alias("chain"), F.lit(m).cast("bigint").alias("mask"),
                               F.lit(f).cast("bigint").alias("flip")) for s, m, f in flips])
    # A differing bit is set on one side only, so only the side that lacks it probes with it.
    probes = (
        prints.select(F.col("fingerprint").alias("a"), F.explode(probe).alias("p"))
        .filter((F.col("p.flip") == 0) | (F.col("a").bitwiseAND(F.col("p.flip")) == 0))
        .select("a", "p.chain", "p.flip",
                F.col("a").bitwiseAND(F.col("p.mask")).bitwiseOR(F.col("p.flip")).alias("key"))
    )
    homes = F.array(*[F.struct(F.lit(s).alias("chain"), F.lit(_signed(chains[s][1])).cast("bigint").alias("mask"))
                      for s in range(count)])
    base = prints.select(F.col("fingerprint").alias("b"), F.explode(homes).alias("h")).select(
        "b", "h.chain", F.col("b").bitwiseAND(F.col("h.mask")).alias("key")
    )
    differ = F.col("a").bitwiseXOR(F.col("b"))
    fits = F.lit(True)
    for start in range(count):
        for step in range(2, count - 1):
            cut = F.bit_count(differ.bitwiseAND(F.lit(_signed(chains[start][step])).cast("bigint")))
            fits = fits & ((F.col("chain") != start) | (cut <= step))
    near = F.bit_count(differ) <= max_distance
    once = (F.col("flip") != 0) | (F.col("a") < F.col("b"))
    return probes.join(base, ["chain", "key"]).filter(once & fits & near).select("a", "b")


def grouped(docs: DataFrame, width: int = WIDTH, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach. Rows with equal
    fingerprints, texts without words among them, are one group from the start, so
    copies cost no links. Rows without an id take part and have the component of
    the others; null if nobody there has an id. Repeated rows stay repeated. An empty
    table gives an empty one.
    """
    prints = stored(with_fingerprint(docs, width), "fingerprints")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    found = components(link_fingerprints(distinct, max_distance), "a", "b")
    joined = distinct.join(found, distinct["fingerprint"] == found["node"], "left")
    with_root = joined.select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("root")
    )
    firsts = with_root.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = with_root.join(firsts, "root").select("fingerprint", "component_id", "root")
    return prints.join(members, "fingerprint")


def near_duplicates(docs: DataFrame, width: int = WIDTH, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id), the fingerprint as 16 hex digits."""
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return grouped(docs, width, max_distance).select("doc_id", digits, "component_id")


def keep_first(docs: DataFrame, width: int = WIDTH, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group kept.

    The row with the smallest id stays, ids before no id; among rows of one id the
    one with the least digest of its text, and one of rows that repeat wholly.
    """
    groups = grouped(docs, width, max_distance)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    kept = groups.groupBy("root").agg(first).select("first.doc_id", "first.text_key")
    rows = docs.select("doc_id", text_key().alias("text_key"), F.struct("*").alias("row"))
    chosen = rows.join(kept, same_key(rows, kept, ["doc_id", "text_key"]), "left_semi")
    return chosen.dropDuplicates(["doc_id", "text_key"]).select("row.*")
