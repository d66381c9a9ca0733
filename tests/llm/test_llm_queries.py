"""Registered queries against SQL, and the pipeline against its stages in plain Python."""

from __future__ import annotations

import hashlib
import os
import re
import sys

import public_tokenizers
import pytest
from oracle_check import compare, connect
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
import odd  # noqa: E402
from test_llm_documents import plain_fingerprint, water_levels  # noqa: E402

from tidemark.llm import linespread, simhash  # noqa: E402
from tidemark.llm.registry import ORACLE, QUERIES, TOKENIZER  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "line dedup",
        "simhash near-dedup",
        "mixing sources to target weights",
        "bpe encoding and decoding",
    ]


def plain_lines(rows):
    """Texts by id after the line dedup."""
    spots: dict = {}
    for doc_id, text, source in rows:
        for at, line in enumerate((text or "").split("\n")):
            bare = line.strip(" \t\r")
            if bare:
                spots.setdefault(bare, []).append((doc_id, at, source))
    gone = set()
    for found in spots.values():
        if len({s for _, _, s in found}) >= linespread.MIN_SITES:
            gone.update((d, at) for d, at, _ in sorted(found, key=lambda f: f[:2])[1:])
    return {
        d: "\n".join(line for at, line in enumerate((text or "").split("\n")) if (d, at) not in gone) for d, text, _ in rows
    }


def plain_kept(texts):
    """Ids of the documents that stay after the near-duplicates go."""
    prints = {d: int(plain_fingerprint(t), 16) for d, t in texts.items()}
    ids, root = sorted(prints), {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= simhash.MAX_DISTANCE:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [d for d in ids if root[d] == d]


def plain_copies(docs):
    """How often the mix takes each document."""
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, (t, _) in docs.items()}
    total: dict = {}
    for d, (_, source) in docs.items():
        total[source] = total.get(source, 0) + size[d]
    target, copies = water_levels(total), {}
    for source in total:
        own = sorted((d for d in docs if docs[d][1] == source), key=lambda d: hashlib.md5(str(d).encode()).hexdigest())
        start = 0
        for d in own:
            copies[d] = sum(start + k * total[source] + size[d] / 2 <= target[source] for k in range(2))
            start += size[d]
    return copies


def test_pipeline_against_plain_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r.doc_id for r in QUERIES["op8_quality_classifier"](spark, sf_dir).filter("predicted = 1").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good]
    source = {d: s for d, _, s in rows}
    texts = plain_lines(rows)
    kept = {d: (texts[d], source[d]) for d in plain_kept(texts)}
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path(TOKENIZER)), []
    for d, times in plain_copies(kept).items():
        ids = tokenizer.encode(kept[d][0], add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want += [(d, len(ids), digest, back)] * times
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("rows", [odd.ROWS, []])
def test_stages_on_odd_rows(spark, tmp_path, rows):
    docs = odd.docs(spark, rows)
    odd.labels(spark, [(1, 1, 0), (2, 0, 1), (None, 1, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() > 0 or not rows
