"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Frequent pieces, counted over all documents, are compiled into an acyclic automaton
that shares prefixes and suffixes. Every transition carries how many pieces come
before those behind it, so the sum along a path numbers the piece, and the number
leads to its ids. The automaton is one file of arrays that each executor maps into
memory; all its workers share the pages. A batch of pieces walks it together, one
byte per step. Pieces that it does not know are merged exactly, many at once.

Which pieces the lexicon holds changes the speed, never the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm import words
from tidemark.llm.common import shipped, slices, texts_of, unpacked
from tidemark.session import scratch_path
from tidemark.sources import stored

LEXICON = 1 << 16
# Pieces a counting task holds at once, see ``_shrink``.
COUNTED = 1 << 18
# Longer pieces are merged one by one with a heap, so their cost stays near linear.
TOGETHER = 64


@dataclass
class Vocabulary:
    """What a byte-level BPE file says: ids of bytes, merges, texts of ids, special strings."""

    of_byte: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray
    rank: np.ndarray
    size: int
    texts: list[bytes]
    specials: dict[str, int]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Positions in ``pairs`` by rank, or the number of merges where there is none."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], len(self.pairs))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read a tokenizer file; refuses settings that would change ids in other ways."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, splitter = spec["model"], spec["pre_tokenizer"]
    plain = model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
    plain = plain and splitter["type"] == "ByteLevel" and not splitter["add_prefix_space"] and splitter["use_regex"]
    if not plain or spec["normalizer"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    ids, letters = model["vocab"], _byte_letters()
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*ids.values(), *specials.values()]) + 1
    texts = [b""] * size
    for token, number in ids.items():
        texts[number] = bytes(letters[c] for c in token)
    for token, number in specials.items():
        texts[number] = token.encode()
    of_byte = np.empty(256, np.int64)
    for letter, byte in letters.items():
        of_byte[byte] = ids[letter]
    split = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    key = np.array([ids[a] * size + ids[b] for a, b in split], np.int64)
    merged = np.array([ids[a + b] for a, b in split], np.int64)
    order = np.argsort(key, kind="stable")
    return Vocabulary(of_byte, key[order], merged, order, size, texts, specials)


def merge_one(word: bytes, vocab: Vocabulary) -> list[int]:
    """The ids of one piece: always the merge of lowest rank, the leftmost of equals."""
    symbols = vocab.of_byte[np.frombuffer(word, np.uint8)]
    none = len(vocab.pairs)
    ranks = vocab.ranks(symbols[:-1], symbols[1:]).tolist()
    ids, count = symbols.tolist(), len(symbols)
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    heap = [(rank, at, ids[at], ids[at + 1]) for at, rank in enumerate(ranks) if rank < none]
    heapq.heapify(heap)

    def push(at: int, right: int) -> None:
        rank = int(vocab.ranks(np.array([ids[at]]), np.array([ids[right]]))[0])
        if rank < none:
            heapq.heappush(heap, (rank, at, ids[at], ids[right]))

    while heap:
        rank, at, left_id, right_id = heapq.heappop(heap)
        right = after[at]
        if ids[at] != left_id or right >= count or ids[right] != right_id:
            continue
        ids[at], ids[right] = int(vocab.merged[rank]), -1
        after[at] = after[right]
        if after[at] < count:
            before[after[at]] = at
            push(at, after[at])
        if before[at] >= 0:
            push(before[at], at)
    return [i for i in ids if i >= 0]


def merge_many(found: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pool, begin, counts): piece k has the ids ``pool[begin[k]:begin[k] + counts[k]]``.

    Pieces of one length are merged together as rows of a matrix.
    """
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    counts, begin = lengths.copy(), np.zeros(len(found), np.int64)
    pools, filled = [np.zeros(0, np.int32)], 0
    none = len(vocab.pairs)
    for length in np.unique(lengths):
        which = np.flatnonzero(lengths == length)
        if length > TOGETHER:
            for k in which.tolist():
                pools.append(np.array(merge_one(found[k], vocab), np.int32))
                begin[k], counts[k] = filled, len(pools[-1])
                filled += len(pools[-1])
            continue
        flat = np.frombuffer(b"".join(found[k] for k in which.tolist()), np.uint8)
        symbols = vocab.of_byte[flat].reshape(len(which), length)
        sizes = np.full(len(which), length)
        if length > 1:
            ranks = vocab.ranks(symbols[:, :-1], symbols[:, 1:])
            open_rows = np.arange(len(which))
            columns = np.arange(length)[None, :]
            sub, rank = symbols, ranks
            while len(open_rows):
                at = rank.argmin(1)
                each = np.arange(len(at))
                best = rank[each, at]
                go = best < none
                if not go.all():
                    symbols[open_rows[~go]] = sub[~go]
                    open_rows, sub, rank, at, best = open_rows[go], sub[go], rank[go], at[go], best[go]
                    each = each[: len(at)]
                if not len(open_rows):
                    break
                moved = columns > at[:, None]
                shifted = np.concatenate([sub[:, 1:], np.full((len(sub), 1), -1)], 1)
                sub = np.where(moved, shifted, sub)
                sub[each, at] = vocab.merged[best]
                shifted = np.concatenate([rank[:, 1:], np.full((len(rank), 1), none)], 1)
                rank = np.where(moved[:, :-1], shifted, rank)
                sizes[open_rows] -= 1
                for spot in (at - 1, at):
                    inside = np.flatnonzero((spot >= 0) & (spot + 1 < sizes[open_rows]))
                    left, right = sub[inside, spot[inside]], sub[inside, spot[inside] + 1]
                    rank[inside, spot[inside]] = vocab.ranks(left, right)
                edge = np.flatnonzero(at + 1 >= sizes[open_rows])
                edge = edge[at[edge] < rank.shape[1]]
                rank[edge, at[edge]] = none
        pools.append(symbols[np.arange(length)[None, :] < sizes[:, None]].astype(np.int32))
        begin[which], counts[which] = filled + np.cumsum(sizes) - sizes, sizes
        filled += len(pools[-1])
    return np.concatenate(pools), begin, counts


def take(pool: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices ``pool[begin[k]:begin[k] + counts[k]]`` one after another."""
    ends = np.cumsum(counts, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(begin - (ends - counts), counts) + np.arange(total)]


# The automaton -----------------------------------------------------------------------


def _minimal(found: list[bytes]) -> list[tuple[bool, dict[int, int]]]:
    """States (final, byte -> state) of the minimal automaton of sorted, distinct words; state 0 starts."""
    states: list[tuple[bool, dict[int, int]]] = []
    register: dict[tuple, int] = {}

    def freeze(node: list) -> int:
        key = (node[0], tuple(sorted(node[1].items())))
        if key not in register:
            register[key] = len(states)
            states.append((node[0], dict(key[1])))
        return register[key]

    path: list[list] = [[False, {}]]
    previous = b""
    for word in found:
        same = 0
        while same < min(len(word), len(previous)) and word[same] == previous[same]:
            same += 1
        for depth in range(len(previous), same, -1):
            done = freeze(path.pop())
            path[-1][1][previous[depth - 1]] = done
        path.extend([False, {}] for _ in word[same:])
        path[-1][0] = True
        previous = word
    for depth in range(len(previous), 0, -1):
        done = freeze(path.pop())
        path[-1][1][previous[depth - 1]] = done
    start = freeze(path[0])
    last = len(states) - 1 - start
    # Number states from the start downwards, so that state 0 starts.
    flip = len(states) - 1
    assert last == 0
    return [(final, {b: flip - t for b, t in edges.items()}) for final, edges in reversed(states)]


FIELDS = ("base", "final", "check", "target", "skip", "offset", "ids")


def compile_lexicon(found: list[bytes], vocab: Vocabulary) -> bytes:
    """The automaton and the ids of its words as one block of arrays."""
    found = sorted(set(found) - {b""})
    states = _minimal(found)
    behind = [0] * len(states)
    for number in range(len(states) - 1, -1, -1):
        final, edges = states[number]
        behind[number] = int(final) + sum(behind[t] for t in edges.values())
    # Transitions of all states are laid into one row: slot base + byte, checked by state.
    base, used, free = np.zeros(len(states), np.int64), bytearray(256 * 2), 256
    slots: dict[int, tuple[int, int, int]] = {}
    # Where to look next, by the number of transitions: earlier slots are mostly taken.
    hint: dict[int, int] = {}
    for number in sorted(range(len(states)), key=lambda k: -len(states[k][1])):
        edges = states[number][1]
        if not edges:
            continue
        marks = sorted(edges)
        at = free if len(marks) == 1 else max(free, hint.get(len(marks), 0))
        while True:
            if at + 256 >= len(used):
                used.extend(bytes(len(used)))
            shift = at - marks[0]
            if not any(used[shift + b] for b in marks):
                break
            at += 1
        hint[len(marks)] = at
        base[number], before = shift, int(states[number][0])
        for b in marks:
            used[shift + b] = 1
            slots[shift + b] = (number, edges[b], before)
            before += behind[edges[b]]
        while used[free]:
            free += 1
    size = max(slots, default=0) + 257
    check, target, skip = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for slot, (number, there, before) in slots.items():
        check[slot], target[slot], skip[slot] = number, there, before
    pool, begin, counts = merge_many(found, vocab)
    ids = take(pool, begin, counts)
    final = np.array([state[0] for state in states])
    arrays = [base, final, check, target, skip, np.concatenate(([0], np.cumsum(counts))), ids]
    arrays = [np.ascontiguousarray(a, np.int32) for a in arrays]
    head = np.array([len(a) for a in arrays], np.int64)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


@dataclass
class Lexicon:
    """The arrays of a compiled lexicon."""

    base: np.ndarray
    final: np.ndarray
    check: np.ndarray
    target: np.ndarray
    skip: np.ndarray
    offset: np.ndarray
    ids: np.ndarray

    @classmethod
    def over(cls, block: np.ndarray) -> Lexicon:
        """Views into a block of bytes, such as a memory-mapped file."""
        head = block[: 8 * len(FIELDS)].view(np.int64)
        ends = 8 * len(FIELDS) + 4 * np.cumsum(head)
        return cls(*(block[e - 4 * n : e].view(np.int32) for n, e in zip(head.tolist(), ends.tolist(), strict=True)))

    def numbers(self, found: list[bytes]) -> np.ndarray:
        """The number of each word in the lexicon, -1 if it is not there."""
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        data = np.frombuffer(b"".join(found), np.uint8).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        result = np.full(len(found), -1)
        live = np.flatnonzero(lengths > 0)
        state, number = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            slot = self.base[state] + data[starts[live] + step]
            good = self.check[slot] == state
            live, slot = live[good], slot[good]
            state, number = self.target[slot], number[good] + self.skip[slot]
            step += 1
            done = lengths[live] == step
            ends = done & (self.final[state] == 1)
            result[live[ends]] = number[ends]
            live, state, number = live[~done], state[~done], number[~done]
        return result


@lru_cache(maxsize=2)
def opened(name: str) -> Lexicon:
    """The lexicon file that the session handed to this executor, mapped into memory."""
    return Lexicon.over(np.memmap(SparkFiles.get(name), np.uint8, "r"))


def encode(texts: list[str], vocab: Vocabulary, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds): text i has ``ids[bounds[i]:bounds[i + 1]]``."""
    pieces = words.split(texts, tuple(vocab.specials))
    count = len(pieces.words)
    number = lexicon.numbers(pieces.words)
    special = {name.encode(): i for name, i in vocab.specials.items()}
    rest = np.flatnonzero(number < 0)
    unseen = [pieces.words[k] for k in rest.tolist()]
    known = number[number >= 0]
    fresh, begin_fresh, counts_fresh = merge_many([b"" if w in special else w for w in unseen], vocab)
    # Of the lexicon's ids those of the pieces here, then those merged here, then special ones.
    counts, begin = np.zeros(count, np.int64), np.zeros(count, np.int64)
    listed = lexicon.offset[known + 1] - lexicon.offset[known]
    pool = take(lexicon.ids, lexicon.offset[known], listed)
    counts[number >= 0], begin[number >= 0] = listed, np.cumsum(listed) - listed
    counts[rest], begin[rest] = counts_fresh, len(pool) + begin_fresh
    pool = np.concatenate([pool, fresh])
    for k, word in zip(rest.tolist(), unseen, strict=True):
        if word in special:
            begin[k], counts[k] = len(pool), 1
            pool = np.append(pool, special[word])
    lengths = counts[pieces.codes]
    ids = take(pool, begin[pieces.codes], lengths)
    return ids.astype(np.int32), np.concatenate(([0], np.cumsum(lengths)))[pieces.at]


def decode(ids: list[int], vocab: Vocabulary) -> str:
    """The text of the ids; bytes that are not UTF-8 become replacement characters."""
    table = vocab.texts
    return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


# Jobs ------------------------------------------------------------------------------


def _shrink(counts: Counter) -> Counter:
    """Half as many pieces: the count of the first to go is taken off those that stay.

    This keeps every piece that makes up more than one part in ``COUNTED / 2`` of what
    a task has seen, whatever the order.
    """
    values = np.fromiter(counts.values(), np.int64, len(counts))
    cut = int(np.partition(values, len(values) // 2)[len(values) // 2])
    return Counter({word: count - cut for word, count in counts.items() if count > cut})


def frequent(docs: DataFrame, size: int = LEXICON) -> list[bytes]:
    """Up to ``size`` of the most frequent pieces of all documents.

    Tasks count over all their rows in bounded memory; sums meet by aggregation. A
    histogram of the sums, in steps of an eighth of a power of two, gives the least
    sum that at most ``size`` pieces reach, and only those come to the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            pieces = words.split(texts_of(batch))
            times = np.bincount(pieces.codes, minlength=len(pieces.words)).tolist()
            for word, count in zip(pieces.words, times, strict=True):
                counts[word] += count
            while len(counts) > COUNTED:
                counts = _shrink(counts)
        if len(counts) > COUNTED // 2:
            counts = _shrink(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "times"]
        )

    counted = docs.select("text").mapInArrow(run, "word binary, times bigint")
    sums = stored(counted.groupBy("word").agg(F.sum("times").alias("times")), "pieces")
    step = F.floor(F.log2("times") * 8).cast("int")
    room, least = size, None
    for row in sums.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row.step
    if least is None:
        return []
    top = sums.filter(step >= least).select("word").collect()
    return [bytes(row.word) for row in top if len(row.word) <= TOGETHER]


def publish(spark: SparkSession, block: bytes) -> str:
    """Write a block to the shared folder and hand the file to all executors; its name there."""
    path = scratch_path(spark, "lexicon") + ".bin"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        for at in range(0, len(block), 1 << 20):
            stream.write(bytearray(block[at : at + (1 << 20)]))
    finally:
        stream.close()
    return shipped(spark, path)


def vocabulary_there(name: str) -> Vocabulary:
    """The vocabulary of a tokenizer file that the session handed to this executor."""
    return vocabulary(SparkFiles.get(name))


def build(docs: DataFrame, path: str, size: int = LEXICON) -> str:
    """Compile the lexicon of ``docs``; the name of its file on the executors."""
    return publish(docs.sparkSession, compile_lexicon(frequent(docs, size), vocabulary(path)))


@cache
def _decimals(size: int) -> list[bytes]:
    return [str(i).encode() for i in range(size)]


def _digests(ids: list[int], vocab: Vocabulary) -> tuple[str, str]:
    decimal = _decimals(vocab.size)
    listed = hashlib.sha256(b",".join([decimal[i] for i in ids])).hexdigest()
    return listed, hashlib.sha256(decode(ids, vocab).encode()).hexdigest()


def with_ids(docs: DataFrame, path: str, name: str) -> DataFrame:
    """One row per document: ``row``, all input columns as a struct, and ``ids``."""
    tokenizer = shipped(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(map(unpacked, batches)):
            ids, bounds = encode(texts_of(batch), vocabulary_there(tokenizer), opened(name))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "ids"])

    packed = docs.select(F.struct("*").alias("row"))
    return packed.mapInArrow(run, StructType([packed.schema["row"], StructField("ids", ArrayType(IntegerType(), False))]))


def digests(docs: DataFrame, path: str, name: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document; null texts count as empty.

    The text that is digested is decoded from the ids. Repeated rows stay, a null
    doc_id too; an empty table gives an empty one. Other columns aren't read. Executors
    get the file at ``path`` from the driver.
    """
    tokenizer = shipped(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary_there(tokenizer)
        for batch in slices(batches):
            ids, bounds = encode(texts_of(batch), vocab, opened(name))
            each = [_digests(ids[a:b].tolist(), vocab) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [batch.column("doc_id"), pa.array(np.diff(bounds)), *(pa.array(c, pa.string()) for c in zip(*each, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select("doc_id", "text")
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return narrow.mapInArrow(run, StructType([narrow.schema["doc_id"], *fields]))
