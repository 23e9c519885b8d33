"""Token files and packing against the tokenizer applied to each whole text."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import LONG, ROWS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskflow.llm import queries
from riskflow.llm.packing import closest_fill, pack, pack_block
from riskflow.llm.queries import LLM_QUERIES
from riskflow.llm.token_files import Shard, read_documents, write_token_files
from riskflow.llm.tokens import WordEncoder, vocabulary_path
from riskflow.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZé.,' \t\x1c\x85<|>9中İ\u0301", max_size=30), max_size=6))
def test_words_give_the_ids_of_the_whole_text(texts):
    words = WordEncoder(vocabulary_path())
    plain = words.tokenizer
    ids, offsets = words.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i]:offsets[i + 1]].tolist() == want


def test_letters_that_the_normalizer_splits_before_a_mark():
    """A dotted capital I is lower-cased to two signs, and some letters are decomposed for good."""
    words = WordEncoder(vocabulary_path())
    texts = [f"{before}{letter}{mark}" for letter in "İ\u0958\u09dc\u0b5d\u0f43é"
             for before in ("", "a") for mark in ".,"]
    ids, offsets = words.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i]:offsets[i + 1]].tolist() == want


def test_query_of_token_files(spark, tokenizer):
    got = {r["doc_id"]: r for r in LLM_QUERIES["op4_token_files"](spark, SF_DIR).collect()}
    start = 0
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    assert len(rows) == len(got)
    for row in rows:
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 1]
        r = got[row["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_of_edge_rows(spark, tokenizer):
    folder = scratch_dir(spark, "test-token-files")
    manifest = write_token_files(documents(spark), folder, vocabulary_path(), end_id=1,
                                 sequence_length=64, shards=3)
    assert sum(r["documents"] for r in manifest.collect()) == len(ROWS)
    got = read_documents(spark, folder).orderBy("start").collect()
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in ordered]
    for r, row in zip(got, ordered):
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1]
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), crc(ids))


def test_sequences_have_one_length_and_padding_only_at_a_shards_end(spark):
    folder = scratch_dir(spark, "test-sequences")
    manifest = write_token_files(documents(spark), folder, vocabulary_path(), end_id=1,
                                 sequence_length=64, shards=2)
    for row in manifest.where("ids > 0").collect():
        shard = Shard(folder, row["shard"])
        rows = sum(shard.sequences().get_batch(b).num_rows
                   for b in range(shard.sequences().num_record_batches))
        assert rows == -(-row["ids"] // 64)
        for i in (0, rows - 1):
            ids, mask = shard.sequence(i)
            assert len(ids) == len(mask) == 64
        assert mask.sum() == (row["ids"] - 1) % 64 + 1 and mask[0]
        assert ids.base is not None  # a view, no copy


def test_empty_tables(spark):
    folder = scratch_dir(spark, "test-no-tokens")
    assert write_token_files(documents(spark, []), folder, vocabulary_path(), 1).where("ids > 0").isEmpty()
    assert read_documents(spark, folder).isEmpty()
    assert pack(documents(spark, []), vocabulary_path(), 2).isEmpty()


def check_pieces(pieces, texts, tokenizer, capacity=4096):
    """Every id once, sequences without gaps, and all full but powers of two."""
    parts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(parts[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == crc(ids[at:at + p["length"]])
            at += p["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == capacity or at < capacity and at & (at - 1) == 0


def test_query_of_packing(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    pieces = LLM_QUERIES["op9_packing"](spark, SF_DIR).collect()
    check_pieces(pieces, {r["doc_id"]: r["text"] for r in docs}, tokenizer)


def test_packing_of_edge_rows(spark, tokenizer):
    rows = [(i, r[1], *r[2:]) for i, r in enumerate(ROWS)]
    pieces = pack(documents(spark, rows).repartition(2), vocabulary_path(), 2, capacity=256,
                  block_tokens=3000).collect()
    check_pieces(pieces, {r[0]: r[1] for r in rows}, tokenizer, capacity=256)
    assert all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    repeated = pack(documents(spark), vocabulary_path(), 2).where("doc_id = 1").collect()
    assert sum(p["length"] for p in repeated) == 2 * repeated[0]["doc_tokens"]


@given(st.lists(st.integers(1, 40), max_size=12), st.integers(1, 60))
def test_closest_fill_is_the_best_subset_sum(lengths, target):
    used = closest_fill(Counter(lengths), target)
    assert not used - Counter(lengths)
    sums = {0}
    for length in lengths:
        sums |= {s + length for s in sums}
    assert sum(used.elements()) == max(s for s in sums if s <= target)


@given(st.lists(st.integers(1, 200), max_size=40))
def test_blocks_hold_every_id_once(lengths):
    pieces = list(pack_block(np.array(lengths, dtype=np.int64), 64))
    covered = Counter((d, i) for d, start, n, _, _ in pieces for i in range(start, start + n))
    assert covered == Counter((d, i) for d, n in enumerate(lengths) for i in range(n))
    filled = Counter()
    for _, _, n, sequence, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert filled[sequence] == offset
        filled[sequence] += n
    short = [n for n in filled.values() if n != 64]
    assert len(set(short)) == len(short) and all(n & (n - 1) == 0 and n < 64 for n in short)


def test_long_text_is_encoded_whole(tokenizer):
    ids, _ = WordEncoder(vocabulary_path()).encode(pa.array([LONG]))
    assert ids.tolist() == tokenizer.encode(LONG, add_special_tokens=False).ids


def test_query_takes_its_digests_from_the_packed_ids(spark, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "pack", lambda *a, **k: made.append(pack(*a, **k)) or made[0])
    found = LLM_QUERIES["op9_packing"](spark, SF_DIR)
    keys = ["doc_id", "start", "length", "ids_crc32"]
    packed = made[0]
    assert packed.where("ids is null or octet_length(ids) != 4 * length").isEmpty()
    assert found.columns == [c for c in packed.columns if c != "ids"]
    assert found.dtypes == packed.drop("ids").dtypes
    assert sorted(found.select(keys).collect()) == sorted(packed.select(keys).collect())


def test_an_id_with_very_many_rows_is_in_many_shards(spark, tmp_path):
    rows = [(5, f"text {i}") for i in range(900)] + [(5, "same")] * 300 + [(i, "x") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    manifest = write_token_files(docs, f"file://{tmp_path}/out", vocabulary_path(), 1, shards=8, sequence_length=64)
    shards = manifest.collect()
    assert len(shards) == 8 and max(s.documents for s in shards) < 600
    back = read_documents(spark, f"file://{tmp_path}/out").orderBy("start").collect()
    assert len(back) == 2000
    ids = [r.doc_id for r in back]
    assert ids == sorted(ids)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(back, back[1:]))
