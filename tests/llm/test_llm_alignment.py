"""Cross-tokenizer alignment against a walk over the tokens, and against the libraries on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brightweir.llm import token_alignment
from brightweir.llm.byte_bpe import byte_table

PARTS = ["a", "the", " ", "  ", "\n", "\n\n", "▁", "\t", "é", "漢字", "<|endoftext|>", "<s>", "'s", "12", "\r\n", "word", "Ünï", " ", "\x00",
         "<0x0A>", ".", "_", "　", "🙂", "\x1f", "​", " ,", "é"]


class Libraries:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        self.value = {c: b for b, c in enumerate(byte_table())}

    def tokens(self, text):
        """Ids and bytes of both tokenizers over the whole text."""
        if not text:
            return [], []
        a = [(i, bytes(self.value[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        wanted = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == wanted == b"".join(t for _, t in b) else ([], [])


def walked(a, b):
    """Groups and links of two token lists by walking over the bytes."""
    owners = [[k for k, (_, t) in enumerate(side) for _ in t] for side in (a, b)]
    ends = [set(np.cumsum([len(t) for _, t in side]).tolist()) for side in (a, b)]
    links = {(x, y) for x, y in zip(*owners)}
    groups, start = [], 0
    for end in sorted(ends[0] & ends[1]):
        names = [",".join(str(side[k][0]) for k in sorted(set(own[start:end]))) for side, own in ((a, owners[0]), (b, owners[1]))]
        groups.append("|".join(names))
        start = end
    return groups, [(a[x][0], b[y][0]) for x, y in links]


def by_walking(rows):
    libraries = Libraries()
    made = [(doc, walked(a, b), len(a), len(b)) for doc, text in rows for a, b in [libraries.tokens(text)]]
    counts = Counter(pair for _, (_, links), _, _ in made for pair in set(links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    return Counter(
        (doc, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc, (groups, links), n_a, n_b in made
    )


def test_odd_texts_are_aligned_as_by_walking(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE", 400)
    random.seed(3)
    rows = [(i, "".join(random.choice(PARTS) for _ in range(random.randint(0, 14)))) for i in range(1500)]
    rows += [(None, None), (None, "a word"), (7, ""), rows[3], rows[3], (2000, "x" * 3000), (2001, "long text, " * 4000)]
    docs = spark.createDataFrame([(*r, "s", 1, 2, "k", 3) for r in rows], "doc_id long, text string, slice string, key int, pair int, found string, n int")
    found = token_alignment.aligned_documents(docs.repartition(3)).collect()
    assert Counter(map(tuple, found)) == by_walking(rows)


def test_given_documents_are_aligned_as_by_walking(tables):
    docs = tables("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, token_alignment.aligned_documents(docs).collect())) == by_walking(rows)


def test_no_documents(spark):
    assert token_alignment.aligned_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_doubling_finds_the_groups_between_common_ends(seed):
    """Long chains of tokens that end apart take a few rounds, whatever their length."""
    draws = np.random.default_rng(seed)
    length = int(draws.integers(1, 400))
    sides = []
    for _ in range(2):
        cuts = np.flatnonzero(draws.random(length) < draws.choice([0.05, 0.3, 0.9]))
        sides.append(np.unique([*cuts[cuts > 0], length]))
    terminal = token_alignment.jumped(token_alignment.successors(*sides))
    common = np.intersect1d(*sides)
    ends = np.concatenate(sides)
    want = np.searchsorted(common, ends)
    groups = {}
    for label, group in zip(terminal.tolist(), want.tolist()):
        assert groups.setdefault(group, label) == label
    assert len(set(groups.values())) == len(common)
    x, y = token_alignment.overlaps(*sides)
    starts = [np.concatenate([[0], s[:-1]]) for s in sides]
    assert set(zip(x.tolist(), y.tolist())) == {
        (i, j) for i in range(len(sides[0])) for j in range(len(sides[1])) if starts[0][i] < sides[1][j] and starts[1][j] < sides[0][i]
    }
