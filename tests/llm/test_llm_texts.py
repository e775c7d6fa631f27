"""Tokenizers, language and quality: functions over single texts, and their queries."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from brightweir.llm import byte_bpe, langid, packing, quality

# Letters that merge, white space of every kind, marks that join, case that grows.
ODD = list("aaabcÉ  \n\n\t\r'sstre 0123 .,!!==--éñ漢字한\U0001f600\x85\x1c　ʼ²½اΣİ́क़") + ["<|endoftext|>", "'s", "'ll"]
texts = st.lists(st.sampled_from(ODD), max_size=60).map("".join) | st.text(max_size=80)


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.ByteBpe(public_tokenizers.path(byte_bpe.RANKS))


@pytest.fixture(scope="module")
def word_codec():
    return packing.WordBpe(public_tokenizers.path(packing.VOCABULARY))


def ids_of(stored: bytes, kind: str) -> list[int]:
    return np.frombuffer(stored, kind).tolist()


@settings(max_examples=300, deadline=None)
@given(texts)
def test_byte_bpe_has_the_ids_of_tiktoken(codec, reference, text):
    ids = ids_of(next(codec.encode([text])), byte_bpe.IDS)
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text
    spans = codec.offsets(np.array(ids, byte_bpe.IDS), text.encode()).tolist()
    assert spans == [[start, end] for _, start, end in codec.encode_with_offsets(text)]


def test_byte_table_gives_the_bytes_of_the_ranks(codec):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    assert codec.bytes_of == {rank: token for token, rank in ranks.items()}


def test_digest_of_offsets(spark, codec):
    text = "né 漢\U0001f600 tail"
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    first, second, third = byte_bpe.encoded_documents(rows).orderBy("doc_id").collect()
    spans = np.array([[a, b] for _, a, b in codec.encode_with_offsets(text)], byte_bpe.IDS)
    assert first.offsets_sha256 == hashlib.sha256(spans.tobytes()).hexdigest()
    assert second[1:] == third[1:] and third.offsets_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("text", ["a" * 300, "=" * 200, " " * 99, "ab" * 99, "\n \n" * 9, ""])
def test_byte_bpe_of_runs(codec, reference, text):
    assert ids_of(next(codec.encode([text])), byte_bpe.IDS) == reference.encode_ordinary(text)


def test_byte_bpe_of_a_long_text_and_after_forgetting(codec, reference, monkeypatch):
    random.seed(3)
    text = " ".join("".join(random.choices("abcdé", k=random.randint(1, 9))) for _ in range(5000)) + "x" * 5000
    monkeypatch.setattr(byte_bpe, "PIECE", 1000)
    monkeypatch.setattr(byte_bpe, "SLICE", 2000)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 100)
    short = ["a b", "", "c\nd"]
    got = [ids_of(ids, byte_bpe.IDS) for ids in codec.encode([short[0], text, *short[1:]])]
    assert got == [reference.encode_ordinary(t) for t in (short[0], text, *short[1:])]


def test_offsets_cover_split_characters(codec):
    text = "né 漢\U0001f600"
    spans = codec.encode_with_offsets(text)
    assert codec.decode(i for i, _, _ in spans) == text
    for i, start, end in spans:
        assert codec.bytes_of[i] in text[start:end].encode()
    # A token that holds a part of a character decodes to the replacement character.
    part = next(i for i, _, _ in spans if codec.bytes_of[i][-1] >= 0xC0 or codec.bytes_of[i][0] in range(0x80, 0xC0))
    assert "�" in codec.decode([part])


def test_token_columns(spark, reference):
    path = public_tokenizers.path(byte_bpe.RANKS)
    df = spark.createDataFrame([(1, "né 漢"), (2, None)], "doc_id int, text string")
    df = df.select(byte_bpe.token_ids(df.text, path).alias("ids"), byte_bpe.token_offsets(df.text, path).alias("offsets"))
    first, second = df.select("ids", "offsets", byte_bpe.decoded_text(df.ids, path).alias("back")).collect()
    assert first.ids == reference.encode_ordinary("né 漢") and first.back == "né 漢"
    assert [o.id for o in first.offsets] == first.ids and first.offsets[-1].end == 4
    assert second.ids == [] and second.back == ""


@settings(max_examples=300, deadline=None)
@given(texts)
def test_word_bpe_has_the_ids_of_the_library(word_codec, text):
    whole = Tokenizer.from_str(word_codec.tokenizer.to_str())
    assert next(word_codec.encode(pa.array([text]))).tolist() == whole.encode(text, add_special_tokens=False).ids


SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|", "|>", "<|ENDOFTEXT|>", "tree", "Tree.", " ", "\n", "é", "..", "\u0301"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(SPECIAL), max_size=8).map("".join))
def test_special_strings_in_words_are_what_the_library_makes_of_them(word_codec, text):
    library = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    assert next(word_codec.encode(pa.array([text]))).tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_bpe_of_a_long_text_and_after_forgetting(word_codec, monkeypatch):
    random.seed(4)
    text = " ".join("".join(random.choices("abcdé.", k=random.randint(1, 9))) for _ in range(5000))
    wanted = word_codec.tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "PIECE", 1000)
    monkeypatch.setattr(packing, "SLICE", 2000)
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    assert [ids.tolist() for ids in word_codec.encode(pa.array(["a", text, ""]))][1:] == [wanted, []]


def phrases_by_search(known: bytes, text: bytes) -> int:
    """Greedy parsing by searching for ever longer pieces."""
    at = count = 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in known:
            size += 1
        at += max(1, size - 1)
        count += 1
    return count


def test_phrases_are_longest_matches():
    random.seed(5)
    known = {lang: langid.letters_of("".join(random.choices(letters, k=400))) for lang, letters in (("x", "abcd "), ("y", "cdefé "))}
    model = langid.Model(known)
    for _ in range(20):
        points = langid.letters_of("".join(random.choices("abcdefgé  .9", k=random.randint(0, 900))))
        got = model.phrases([points])[0].tolist()
        symbols = model._built["classes"][points]
        blocks = [symbols[i : i + langid.BLOCK].tobytes() for i in range(0, len(symbols), langid.BLOCK)]
        wanted = [sum(phrases_by_search(model._built["classes"][known[lang]].tobytes(), b) for b in blocks) for lang in ("x", "y")]
        assert got == wanted


@pytest.mark.parametrize("dense", [0, 256 << 20])
def test_no_letter_is_merged(monkeypatch, dense):
    """Many scripts, and languages that differ only in letters that are spread thin."""
    monkeypatch.setattr(langid, "DENSE_BYTES", dense)
    random.seed(6)
    alphabets = {"a": "abcdefghijklmnopqrstuvwxyz", "g": [chr(c) for c in range(0x3B1, 0x3CA)], "r": [chr(c) for c in range(0x430, 0x450)]}
    alphabets |= {"k": [chr(c) for c in range(0xAC00, 0xAC00 + 900)], "z": [chr(c) for c in range(0x4E00, 0x4E00 + 900)]}
    alphabets["y"] = [chr(c) for c in range(0x4E00 + 450, 0x4E00 + 1350)]
    known = {n: langid.letters_of("".join(random.choices(a, k=2000))) for n, a in alphabets.items()}
    model = langid.Model(known)
    for name, letters in alphabets.items():
        text = "".join(random.choices(letters, k=600)) + " \U00010400"
        points = langid.letters_of(text)
        wanted = []
        for n in model.languages:
            strings = ["".join(map(chr, p)) for p in (known[n], points)]
            wanted.append(sum(phrases_by_search(strings[0], strings[1][i : i + langid.BLOCK]) for i in range(0, len(points), langid.BLOCK)))
        assert model.phrases([points])[0].tolist() == wanted
        assert model.predict([text])[0] == [name]


def test_letters():
    assert "".join(chr(p) if p else " " for p in langid.letters_of("Ab, cD9 É!漢")) == "ab cd é 漢"
    assert len(langid.letters_of("12 !?\n")) == 0 and len(langid.letters_of("12 é"[:3])) == 0


def test_nothing_to_learn_from():
    assert langid.Model({}).predict(["abc", None]) == (["und", "und"], [0.0, 0.0])
    names, scores = langid.Model({"x": langid.letters_of("abab")}).predict(["ab", "12", None, "zz"])
    assert names == ["x", "und", "und", "x"] and 0 <= min(scores) and max(scores) <= 1


def test_language_accuracy_on_held_out(spark, tables):
    docs = tables("documents", "0.01")
    got = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count()
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_ignores_labels_of_held_out_rows(spark):
    rows = [(i, ("der die das und " if i % 2 else "the of and that ") * 9, "de" if i % 2 else "en") for i in range(40)]
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    wrong = [(i, t, "xx" if i in held else lang) for i, t, lang in rows]
    more = [(None, "der", "zz"), (100, "the", None), (101, None, "de"), (102, "1 2", "en"), (102, "1 2", "en")]
    schema = "doc_id int, text string, lang string"
    plain, changed = (langid.identified(spark.createDataFrame(r + more, schema)).collect() for r in (rows, wrong))
    assert sorted(map(str, plain)) == sorted(map(str, changed))
    assert {r.lang_pred for r in plain} <= {"de", "en", "und"}
    assert [r.lang_pred for r in plain if r.doc_id in (101, 102)] == ["und"] * 3


def test_sample_is_of_distinct_texts_and_whole_ones(spark):
    random.seed(7)
    learned = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5]
    rows = [(learned[i], "licence of the head " * 500, "a") for i in range(800)]
    # Every text has the same long head and its own rest.
    rows += [(learned[1000 + i], "shared head " * 200 + " ".join(random.choices(["tail", "rest", f"w{chr(97 + i)}x"], k=500)), "b") for i in range(20)]
    rows += [(learned[1100 + 2 * i + j], " ".join(random.choices("qwert zuiop asdf ghj".split(), k=9000)), f"l{i}") for i in range(12) for j in range(2)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    strings = {lang: "".join(chr(p) if p else " " for p in points) for lang, points in model.texts.items()}
    # The copies are one text; many languages have their whole share each.
    assert len(strings["a"]) < 11_000
    assert all(len(strings[f"l{i}"]) == langid.SYMBOLS for i in range(12))
    assert all(f"w{chr(97 + i)}x" in strings["b"] for i in range(20))


def counts_by_search(text: str) -> tuple:
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("ab \n\t\x1c\x85é#|")), max_size=300).map("".join))
def test_base_counts(text):
    assert quality.base_counts(text) == counts_by_search(text)


def test_base_counts_of_a_text_in_pieces(monkeypatch):
    random.seed(6)
    text = " ".join(random.choices(["a", "bc", "def", "ü"], k=3000))
    monkeypatch.setattr(quality, "PIECE", 64)
    assert quality.base_counts(text) == counts_by_search(text)


def test_quality_on_labelled_rows(spark, tables):
    docs, labels = tables("documents", "0.01"), tables("labels", "0.01")
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert len(got) == docs.count()
    for row in docs.limit(200).collect():
        r = got[row.doc_id]
        counts = counts_by_search(row.text)
        assert tuple(r[name] for name in quality.COUNTS) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r.base_failed and r.kept)
    known = [(got[r.doc_id], r.quality) for r in labels.collect()]
    good = [r.kept for r, q in known if q == 1 and not r.base_failed]
    bad = [r.kept for r, q in known if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_quality_without_labels_and_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, "w " * 30), (1, "w " * 30), (None, " ".join("abcdefghijklmnopqrstuvwxy")), (2, None), (3, "")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 1)], "doc_id int, quality int, toxic int")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_repeat_words, r.base_failed, r.kept) for r in quality.quality(docs, labels).collect()))
    assert got == [(0, 25, 0, False, True), (1, 30, 30, True, False), (1, 30, 30, True, False), (2, 0, 0, True, False), (3, 0, 0, True, False)]


def test_calibration_moves_probabilities_to_the_labels():
    random.seed(7)
    good = [" ".join(random.choices(["the", "of", "tree", "house"], k=40)) for _ in range(60)]
    bad = [" ".join(random.choices(["buy", "###", "now", "$$$"], k=40)) for _ in range(60)]
    made = quality.fit(good + bad, np.array([True] * 60 + [False] * 60), np.arange(120) % 5 == 0)
    assert made.probability(good[1]) > 0.9 and made.probability(bad[1]) < 0.1
    assert quality.fit(good, np.ones(60, bool), np.zeros(60, bool)) is None
