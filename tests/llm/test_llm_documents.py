"""Operators on documents: odd rows, empty tables, brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import odd  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tidemark.llm import boosting, curriculum, dac, factorization, linespread, registry, simhash, transducer, words  # noqa: E402
from tidemark.llm.registry import TOKENIZER  # noqa: E402

PATH = public_tokenizers.path(TOKENIZER)


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# SimHash ---------------------------------------------------------------------------


def plain_fingerprint(text, width=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return "0" * 16
    grams = [" ".join(found[i : i + width]) for i in range(max(1, len(found) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    value = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    return f"{value:016x}"


def test_fingerprints_of_odd_rows(spark):
    found = simhash.near_duplicates(odd.docs(spark))
    got = sorted_rows(found, "doc_id", "fingerprint")
    assert got == sorted(((r[0], plain_fingerprint(r[1])) for r in odd.ROWS), key=repr)
    by_id = {r.doc_id: r.component_id for r in found.collect() if r.doc_id is not None}
    assert by_id[5] == by_id[7] == by_id[4] == 4 and by_id[1] == 1


def test_fingerprint_links_against_all_pairs(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for value in prints[:30]:
        for flips in (1, 2, 2, 3):
            changed = value
            for bit in rng.sample(range(64), flips):
                changed ^= 1 << bit
            prints.append(changed)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for most in (1, 2, 3):
        table = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
        got = {tuple(sorted(r)) for r in simhash.link_fingerprints(table, most).collect()}
        want = {
            tuple(sorted((signed[i], signed[j])))
            for i in range(len(prints))
            for j in range(i)
            if (prints[i] ^ prints[j]).bit_count() <= most
        }
        assert got == want


def test_keep_first_keeps_one_row_of_each_group(spark):
    docs = odd.docs(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 6, 8, 8, 9]
    assert kept.filter("doc_id is null").count() == 1
    assert simhash.keep_first(odd.none(spark)).count() == 0


# Line dedup --------------------------------------------------------------------------


def test_shared_line_stays_once(spark):
    docs = odd.docs(spark)
    cleaned = linespread.line_dedup(docs, min_sites=3)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    texts = {r.doc_id: (r.text, r.n_chars) for r in cleaned.filter("doc_id < 8").collect()}
    assert texts[1] == (odd.ROWS[0][1], 44)
    assert texts[2] == ("Five six seven eight nine.", 26)
    assert texts[3] == ("Ten eleven twelve.", 18)
    assert texts[4] == (None, None) and texts[5] == ("", 0) and texts[7][0] == " \t\n \n"
    assert sorted_rows(linespread.line_dedup(docs, min_sites=4), "doc_id", "text") == sorted_rows(docs, "doc_id", "text")
    assert linespread.line_dedup(odd.none(spark)).count() == 0


def test_line_dedup_of_one_document_that_repeats_a_common_line(spark):
    many = 100_000
    rows = [(k, "common\nown", s) for k, s in enumerate("abcde")] + [(9, "common\n" * many + "last", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in linespread.report(docs).collect()}
    assert got[0] == (2, 0, "common\nown") and got[1] == (2, 2, "")
    assert got[9] == (many + 1, many, "last")



def test_every_band_of_the_sketch_agrees_with_exact_counts(spark):
    rows = [(i * 100 + s, f"line {i}\nown {i} {s}", f"site{s}") for i in range(30) for s in range(i + 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    lines = linespread.occurrences(docs)
    for least in (2, 12, 25):
        got = linespread.boilerplate(lines, least).count()
        assert got == sum(1 for i in range(30) if i + 1 >= least)


def test_sure_lines_hot_lines_and_copies_of_rows(spark):
    """A line on ten sites, one that most documents hold many times, and rows that repeat."""
    rows = [(i, f"own {i}\n  sure line\t\nhot" + "\nhot" * (i % 4), f"site{i % 10}") for i in range(200)]
    rows += [(i, f"own {i}\nrare line", f"site{i % 3}") for i in range(200, 230)]
    rows += rows[:20] + [(5, "hot\nother text of id 5", "site1"), (None, "hot\nno id", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    spots: dict = {}
    for row in rows:
        for at, line in enumerate(row[1].split("\n")):
            spots.setdefault(line.strip(), []).append((row, at))
    want = {}
    for row in rows:
        want[row] = list(enumerate(row[1].split("\n")))
    for found in spots.values():
        if len({row[2] for row, _ in found}) >= linespread.MIN_SITES:
            # Ids are told apart by text here: of id 5 the first row has the line in both.
            first = min(((row[0] is None, row[0] or 0), at, row) for row, at in found if row[0] != 5)
            for row, at in found:
                if (row, at) != (first[2], first[1]):
                    want[row] = [(a, line) for a, line in want[row] if a != at]
    got = sorted_rows(linespread.report(docs), "doc_id", "n_removed", "text")
    expected = [(r[0], len(r[1].split("\n")) - len(want[r]), "\n".join(line for _, line in want[r])) for r in rows]
    assert got == sorted(expected, key=repr)
    assert sum(n for _, n, _ in got) > 600


# Mixing ----------------------------------------------------------------------------


def water_levels(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, free, found = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > most * sizes[n]]
        if not over:
            found.update({n: level * weight[n] for n in free})
            break
        for n in over:
            found[n] = float(most * sizes[n])
            left -= found[n]
            free.discard(n)
    return found


def test_targets_and_taken_words(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a"] * 6 + ["b", "B", "é", None])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = {r.doc_id: r for r in curriculum.plan_of(docs).collect()}
    sizes: dict = {}
    for i, text, source in rows:
        assert plan[i]["size"] == len(text.split())
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want, taken = water_levels(sizes), {}
    for i, _, source in rows:
        assert plan[i].target == pytest.approx(want[source])
        assert plan[i].taken <= 2 * plan[i]["size"]
        taken[source] = taken.get(source, 0) + plan[i].taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 30
    again = {r.doc_id: r for r in curriculum.plan_of(docs.repartition(7)).collect()}
    assert again == plan


def test_targets_of_many_sources_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(curriculum, "BLOCK_BITS", 2)
    rng = random.Random(8)
    # A size of zero, and many ties of size over weight.
    sizes = {f"host{i}": rng.choice([0, 1, 1, 2, 5, 40, 1000]) for i in range(150)} | {None: 700}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r.source: r.target for r in curriculum.targets(table.repartition(5)).collect()}
    assert found == pytest.approx(water_levels(sizes))
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_position_inverts_the_integrated_schedule(spark):
    rows = [(p / 10, s) for p in range(11) for s in (-0.5, 0.0, 0.5)]
    table = spark.createDataFrame(rows, "place double, slope double")
    from pyspark.sql import functions as F

    found = table.select("*", curriculum.position(F.col("place"), F.lit(1.0), F.col("slope")).alias("t")).collect()
    for r in found:
        assert r.t + r.slope * (r.t * r.t - r.t) == pytest.approx(r.place)


def test_training_order_of_odd_rows(spark):
    docs = odd.docs(spark)
    ordered = curriculum.training_order(docs)
    assert ordered.columns == docs.columns
    plan = curriculum.plan_of(docs)
    assert plan.count() == docs.count()
    assert plan.filter("taken > 2 * size").count() == 0
    assert curriculum.training_order(odd.none(spark)).count() == 0
    assert curriculum.plan_of(odd.none(spark)).count() == 0


def test_accounts_are_those_of_the_mix_and_agree_with_the_plan(spark, monkeypatch, tmp_path):
    rng = random.Random(11)
    rows = [(i % 90, " ".join(["w"] * rng.randint(0, 9)), rng.choice(["a", "a", "b", None])) for i in range(200)]
    rows += [*rows[:40], (None, "one two", "a"), (None, None, None), (7, "", "b"), (7, "three", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for table in (docs, odd.docs(spark), odd.none(spark)):
        found, plan = (sorted(map(repr, made(table).collect())) for made in (curriculum.accounts, curriculum.plan_of))
        assert found == plan
    # The query tells what the copies hold: without those of one source nothing of it is taken.
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    whole, ordered = registry.QUERIES["op5_mixing_to_target_weights"](spark, str(tmp_path)).collect(), curriculum.in_order
    monkeypatch.setattr(curriculum, "in_order", lambda *a, **o: ordered(*a, **o).filter("row.source = 'a'"))
    part = registry.QUERIES["op5_mixing_to_target_weights"](spark, str(tmp_path)).collect()
    assert len(whole) == len(part) == len(rows)
    assert 0 < sum(r.taken for r in part) < sum(r.taken for r in whole)


# Classifiers -----------------------------------------------------------------------


def test_trees_find_an_interaction():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(2000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(int)
    forest = boosting.fit(rows[:1500], labels[:1500])
    assert ((forest.score(rows[1500:]) > 0.5) == labels[1500:]).mean() > 0.95
    assert boosting.fit(rows[:10], np.ones(10)).score(rows[:3]).min() > 0.9


def test_machine_learns_a_pair_that_no_sum_of_weights_gives():
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        filler = [f"w{k}" for k in rng.integers(0, 300, 6)]
        texts.append(" ".join(filler + ["insult"] * a + ["group"] * b))
        labels.append(int(a == b))
    owner, term = factorization.terms(texts[:2500])
    machine = factorization.fit(owner, term, np.array(labels[:2500]), factorization.Settings(epochs=25))
    assert ((machine.score(texts[2500:]) > 0.5) == labels[2500:]).mean() > 0.9


def test_machine_scores_are_the_plain_sum_over_pairs():
    rng = np.random.default_rng(3)
    words_ = ["alpha", "be", "gamma-ray", "Délta", "zeta9", "x", "日本語の単語です", "alphabet", "gammas"]
    texts = [" ".join(rng.choice(words_, rng.integers(0, 12))) for _ in range(60)] + ["", " .,! "]

    def plain_terms(text):
        found = set()
        for word in re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower()):
            parts = [word] + ["^" + word[:size] for size in factorization.PREFIXES if len(word) > size]
            found.update(zlib.crc32(part.encode()) & ((1 << factorization.HASH_BITS) - 1) for part in parts)
        return found

    active = np.array(sorted(set().union(*map(plain_terms, texts)))[::2])
    machine = factorization.Machine(-0.3, active, rng.normal(size=len(active)), rng.normal(size=(len(active), 3)))
    place = {term: k for k, term in enumerate(active.tolist())}
    for text, score in zip(texts, machine.score(texts), strict=True):
        known = sorted(place[term] for term in plain_terms(text) if term in place)
        margin = machine.bias + sum(machine.weight[i] for i in known)
        margin += sum(machine.factor[i] @ machine.factor[j] for i in known for j in known if i < j)
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def test_scores_are_a_plain_walk_through_every_tree():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(400, 6)).astype(np.float32)
    rows[:, 2] = rng.integers(0, 3, 400)
    forest = boosting.fit(rows, (rows[:, 0] * rows[:, 1] > 0).astype(int), boosting.Boosting(trees=9, depth=3))
    asked = np.concatenate([rows[:50], forest.threshold[:, :3].clip(-9, 9)[:, [0, 1, 2, 0, 1, 2]].astype(np.float32)])
    for row, score in zip(asked, forest.score(asked), strict=True):
        total = forest.start
        for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value, strict=True):
            node = 0
            while node < 2**forest.depth - 1:
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


@pytest.mark.parametrize("seed", range(6))
def test_a_split_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 30, size=(120, 4)).astype(np.float32)
    labels = (rows[:, seed % 4] + rng.normal(size=120) * 8 > 15).astype(int)
    settings = boosting.Boosting(trees=1, depth=1, least_rows=10)
    forest = boosting.fit(rows, labels, settings)
    chance = labels.mean()
    slope, curve = chance - labels, np.full(120, chance * (1 - chance))

    def part(some):
        return slope[some].sum() ** 2 / (curve[some].sum() + settings.penalty)

    options = []
    for column in range(4):
        values = np.unique(rows[:, column])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, column] <= cut
            if min(low.sum(), (~low).sum()) >= settings.least_rows:
                options.append((part(low) + part(~low) - part(low | True), column, cut))
    best = max(gain for gain, _, _ in options)
    column, cut = int(forest.feature[0, 0]), float(forest.threshold[0, 0])
    assert any(gain == pytest.approx(best) and (c, t) == (column, cut) for gain, c, t in options)
    low = rows[:, column] <= cut
    for node, some in ((1, low), (2, ~low)):
        want = -settings.rate * slope[some].sum() / (curve[some].sum() + settings.penalty)
        assert forest.value[0, node] == pytest.approx(want)


@pytest.mark.parametrize("module,label", [(boosting, "quality"), (factorization, "toxic")])
def test_classifiers_on_odd_rows(spark, module, label):
    docs = odd.docs(spark)
    marks = odd.labels(spark, [(1, 1, 0), (2, 0, 1), (3, 1, 0), (6, 0, 1), (8, 1, 0), (8, 0, 1), (None, 1, 1), (9, None, None)])
    for table, known in ((docs, marks), (docs, odd.labels(spark)), (odd.none(spark), marks)):
        model = module.train(table, known, label)
        found = module.judged(table, model)
        assert found.count() == table.count()
        assert found.filter("score is null or score < 0 or score > 1 or predicted is null or held_out is null").count() == 0
    accepted = boosting.accepted(docs, boosting.train(docs, odd.labels(spark)))
    assert accepted.columns == docs.columns and accepted.count() == docs.count()


@pytest.mark.parametrize("module,label,folds,side", [(boosting, "quality", 5, 0), (factorization, "toxic", 3, 1)])
def test_held_out_accuracy(spark, module, label, folds, side):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = module.judged(docs, module.train(docs, known)).join(known, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == side) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[label] for r in held]) > 0.95
    # A document marked 1 outranks one marked 0.
    one, zero = ([r.score for r in held if r[label] == v] for v in (1, 0))
    assert np.mean([a > b for a in one for b in zero]) > 0.9


# Tokens ----------------------------------------------------------------------------


def library_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_are_those_of_the_library():
    from tokenizers import pre_tokenizers

    splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    rng = random.Random(2)
    letters = "ab1 '  \n\t.stmdrevlé日\u0085 \x1c½"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join("a" + chr(c) + "1" + chr(c) + " " for c in range(a, a + 64)) for a in range(0x80, 0x3000, 64)]
    pieces = words.split(texts)
    for i, text in enumerate(texts):
        want = [text[a:b].encode() for _, (a, b) in splitter.pre_tokenize_str(text)]
        assert [pieces.words[c] for c in pieces.codes[pieces.at[i] : pieces.at[i + 1]]] == want


def test_merges_are_those_of_the_library():
    rng = random.Random(4)
    vocab = transducer.vocabulary(PATH)
    texts = ["".join(rng.choice("aeinorst é日'") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    texts += ["a" * 200, "ab" * 4000, "<|endoftext|><|endoftext|> x", "<|endoftext"]
    lexicon = transducer.Lexicon.over(np.frombuffer(transducer.compile_lexicon([b" the", b"the", b"then", b"a"], vocab), np.uint8))
    ids, bounds = transducer.encode(texts, vocab, lexicon)
    for i, want in enumerate(library_ids(texts)):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want
    assert lexicon.numbers([b" the", b"a", b"the", b"then", b"th", b"", b"thenx"]).tolist() == [0, 1, 2, 3, -1, -1, -1]


def test_bpe_of_odd_rows(spark):
    docs = odd.docs(spark)
    found = transducer.digests(docs, PATH, transducer.build(docs, PATH))
    ids, tokenizer = library_ids([r[1] for r in odd.ROWS]), Tokenizer.from_file(PATH)
    want = [
        (
            row[0],
            len(i),
            hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
            hashlib.sha256(tokenizer.decode(i, skip_special_tokens=False).encode()).hexdigest(),
        )
        for row, i in zip(odd.ROWS, ids, strict=True)
    ]
    assert sorted_rows(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    nothing = odd.none(spark)
    assert transducer.digests(nothing, PATH, transducer.build(nothing, PATH)).count() == 0


def test_bytes_that_are_no_text_decode_as_the_library_does():
    vocab, tokenizer = transducer.vocabulary(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(vocab.size) for _ in range(12)]
        assert transducer.decode(ids, vocab) == tokenizer.decode(ids, skip_special_tokens=False)


def test_codes_give_every_token_back():
    rng = np.random.default_rng(8)
    for ids in (np.zeros(0, int), np.arange(300), rng.integers(0, 50257, 5000), rng.integers(0, 2**32, 2000), np.zeros(513, int)):
        codes = dac.Codes.over(dac.pack(ids))
        assert codes.all().tolist() == ids.tolist()
        for at in rng.integers(0, len(ids), 50) if len(ids) else []:
            assert codes.token(int(at)) == ids[at]


def test_token_files_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(dac, "SHARD_TOKENS", 10)
    files = dac.write(odd.docs(spark), PATH)
    got = sorted_rows(dac.read(files), "start", "doc_id", "n_tokens", "ids_crc32")
    order = sorted(odd.ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for row, ids in zip(order, library_ids([r[1] for r in order]), strict=True):
        ids = [*ids, 2]
        want.append((start, row[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want, key=repr)
    assert dac.read(dac.write(odd.none(spark), PATH)).count() == 0


def test_token_files_in_several_partitions_with_a_document_longer_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(dac, "SHARD_TOKENS", 50)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(300 if i % 17 == 0 else rng.randint(0, 20)))) for i in range(120)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = dac.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.select("part").distinct().count() > 1
    want, start = [], 0
    for (i, _), ids in zip(rows, library_ids([t for _, t in rows]), strict=True):
        ids = [*ids, 2]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted_rows(dac.read(files), "start", "doc_id", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_encoder_that_forgets_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(dac, "REMEMBERED", 40)
    rng, encoder = random.Random(9), dac.LibraryEncoder(PATH)
    for _ in range(6):
        texts = [" ".join(f"w{rng.randint(0, 200)}" for _ in range(rng.randint(0, 30))) + "<|endoftext|>" for _ in range(20)]
        ids, bounds = encoder(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == library_ids(texts)
        assert encoder.size == len(encoder.known) <= 40
