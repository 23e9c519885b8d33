"""Cross-tokenizer alignment against a plain walk over both sides' tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge_rows import LONG, documents

from riskflow.llm import alignment
from riskflow.llm.alignment import Batch, TwoSides, Vocabularies, align, pair_counts, scored
from riskflow.llm.queries import LLM_QUERIES
from riskflow.llm.tokens import vocabulary_path

A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"
ODD = ["\r", "\r\n", "\x1c", "\x85", "​", "﻿", " ", "　", "\xa0", "\t", "\n", "\n\n", " ", "  ",
       "   ", "\x00", "<|endoftext|>", "<s>", "<unk>", "<0x41>", "▁", "é", "é", "漢字", "😀", "'s", "don't",
       "word", "Word", "42", "3.14", "...", "});", "a" * 40, ""]


class Plain:
    """Both libraries on whole texts, and every group and link by walking the tokens."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        letters = sorted(pre_tokenizers.ByteLevel.alphabet())
        self.byte = {c: i for i, c in zip(self._bytes(), sorted(letters, key=ord))}

    @staticmethod
    def _bytes():
        own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
        return own + [b for b in range(256) if b not in own]

    def bytes_a(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, self.bytes_a(i)) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.bytes_b(i)) for i in self.b.encode(text)]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])

    def groups(self, text):
        """(a ids, b ids) of each group and the linked pairs."""
        a, b = self.tokens(text)
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, raw in side:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        stops = {e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}
        groups, links, sides = [], [], [iter(side) for side in spans]
        for stop in sorted(stops):
            left, right = [], []
            for own, side in zip((left, right), sides):
                while not own or own[-1][2] < stop:
                    own.append(next(side))
            groups.append(([t[0] for t in left], [t[0] for t in right]))
            links += [(x[0], y[0]) for x in left for y in right if x[1] < y[2] and y[1] < x[2]]
        return groups, links

    def table(self, rows):
        """Rows of the query for (doc_id, text)."""
        found = [(doc, *self.groups(text)) for doc, text in rows]
        counts, best = Counter(), defaultdict(int)
        for _, _, links in found:
            counts.update(set(links))
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        for doc, groups, links in found:
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            yield (doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                   sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), text)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def columns():
    return ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def found(docs, max_pairs=alignment.MAX_TABLE_PAIRS):
    vocab = Vocabularies.of(A, B)
    aligned = align(docs, A, B)
    return scored(aligned, pair_counts(aligned, vocab), vocab, max_pairs).select(*columns())


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_ids_are_those_of_whole_texts(plain):
    both, some = TwoSides(A, B), [*texts(3000), None, "", "a" * 5000, " " * 300, "\n" * 7]
    for part in (some, some[::-1]):
        (a, a_first), (b, b_first) = both.encode(part)
        for i, text in enumerate(part):
            want_a, want_b = plain.tokens(text)
            assert a[a_first[i]:a_first[i + 1]].tolist() == [x for x, _ in want_a], repr(text)
            assert b[b_first[i]:b_first[i + 1]].tolist() == [x for x, _ in want_b], repr(text)


def test_every_entry_of_the_vocabulary_is_encoded_alike(plain):
    side = alignment.byte_side(A)
    some = [t for t in (p.decode("utf-8", "ignore") for p in side.pieces) if t]
    for text, coded in zip(some, plain.a.encode_batch([" " + t for t in some], add_special_tokens=False)):
        assert side.encode(text) == coded.ids, repr(text)


def test_a_full_cache_starts_anew(monkeypatch, plain):
    monkeypatch.setattr(alignment, "KEPT_PIECES", 5)
    both = TwoSides(A, B)
    for text in ["one two three four", "five six seven", "one two"]:
        (a, _), _ = both.encode([text])
        assert a.tolist() == [x for x, _ in plain.tokens(text)[0]]


def test_cuts_of_random_ends():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a_ends, b_ends, first, base = [], [], [0], 0
        for _ in range(rng.integers(1, 5)):
            size = int(rng.integers(0, 60))
            if size:
                a, b = (np.flatnonzero(rng.random(size) < rng.choice([0.1, 0.5, 1])) for _ in "ab")
                a_ends += [base + x for x in a.tolist() if x < size - 1] + [base + size]
                b_ends += [base + x for x in b.tolist() if x < size - 1] + [base + size]
            base += size + 1
            first.append(len(a_ends))
        a_ends, b_ends, first = np.array(a_ends, int), np.array(b_ends, int), np.array(first)
        cuts = alignment.shared_cuts(a_ends, b_ends, first[:-1], first[1:])
        assert (cuts == np.isin(a_ends, b_ends)).all()


def test_links_of_tokens_without_a_common_end():
    ends = np.array([3, 6, 9, 12]), np.array([2, 4, 8, 10, 12])
    batch = Batch.aligned(
        ((np.arange(4), np.array([0, 4])), (np.arange(5), np.array([0, 5]))),
        [np.diff(e, prepend=0) for e in ends])
    assert batch.groups().tolist() == [1]
    assert batch.links(10)[1].tolist() == [0, 1, 11, 12, 22, 23, 33, 34]
    assert batch.texts() == [b"0,1,2,3|0,1,2,3,4"]


def test_awkward_documents(spark, plain):
    rows = [(i, t) for i, t in enumerate(texts(300, seed=9))] + [(None, "no id"), (1, "again"), (1, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = Counter(plain.table(rows))
    assert rows_of(found(docs)) == want
    assert rows_of(found(docs, max_pairs=40)) == want  # most counts by shuffle
    assert rows_of(found(docs, max_pairs=0)) == want


def test_edge_rows_and_clashing_names(spark, plain):
    docs = documents(spark)
    want = Counter(plain.table([(r.doc_id, r.text) for r in docs.collect()]))
    assert rows_of(found(docs)) == want
    assert any(r[7] == "" and r[1] == 0 for r in want) and any(r[1] > len(LONG) / 10 for r in want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert found(docs).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, found(nulls).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_agrees_with_plain_walk(spark, plain):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = Counter(
        (*row[:7], hashlib.sha256(row[7].encode()).hexdigest() if row[7] else "")
        for row in plain.table([(r.doc_id, r.text) for r in docs]))
    df = LLM_QUERIES["op13_alignment"](spark, SF_DIR)
    assert rows_of(df.select(*columns()[:-1], "groups_sha256")) == want
