"""The corpus pipeline against a plain version of it."""

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from brightweir.llm.queries import ORACLE_SQL, QUERIES
from brightweir.llm.common import staged
from test_llm_tables import BASE, MORE, check_pieces, components_by_pairs, fingerprint_by_vote, spans_by_search, squeezed

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    random.seed(8)
    english = "the of and that with river stone house which under"
    german = "der die das und nicht mit fluss stein haus unter"
    rows = []
    for i in range(120):
        words = (english if i % 3 else german).split()
        rows.append((i, " ".join(random.choices(words, k=random.randint(8, 150))), "en" if i % 3 else "de", f"s{i % 2}"))
    rows += [(200 + i, rows[i][1].replace(" ", "  ", 1), "en", "copy") for i in range(1, 20)]
    rows += [(300 + i, rows[i][1] + f" token = {i:032x}", "en", "s") for i in range(20, 30)]
    rows += [(400, None, None, None), (401, "", "en", "s"), (402, "12 34 !", "en", "s"), rows[3]]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)


def test_stages_are_what_plain_code_gives(spark, documents):
    docs = documents
    kept = [tuple(r) for r in documents.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, ""), name)
        assert docs.schema == documents.schema
        kept = PLAIN[name](kept)
        got = Counter(tuple(r) for r in docs.collect())
        if name == "near_dedup":
            # Which of equal ids stays is free, how many do is not.
            assert Counter(r[0] for r in got) == Counter(r[0] for r in kept)
        else:
            assert got == Counter(kept)
        kept = list(got.elements())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    check_pieces(pieces, [(r[0], r[1]) for r in kept])


def exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[squeezed(r[1])].append(r)
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0])) for g in groups.values()]


def near(rows):
    groups = defaultdict(list)
    for r, root in zip(rows, components_by_pairs([fingerprint_by_vote(r[1]) for r in rows])):
        groups[root].append(r)
    return [min(g) for g in groups.values()]


def masked(rows):
    out = []
    for d, text, lang, source, n in rows:
        covered = {i for a, _, _, b in spans_by_search(text, BASE | MORE) for i in range(a, b)}
        new = re.sub("\x00+", "<secret>", "".join("\x00" if i in covered else c for i, c in enumerate(text)))
        out.append((d, new, lang, source, len(new) if covered else n))
    return out


PLAIN = {
    "language": lambda rows: [r for r in rows if re.search("[a-z]", r[1] or "")],
    "exact_dedup": exact,
    "near_dedup": near,
    "secrets": masked,
}


def test_run_gives_the_rows_of_the_stages(spark, documents, tmp_path):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, ""), name)
    again = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert Counter((p.doc_id, p.doc_tokens) for p in run) == Counter((p.doc_id, p.doc_tokens) for p in again)


def test_every_operator_has_its_query():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES] == list(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, ""), name)
        assert docs.count() == 0


def test_documents_without_labels_stay(spark):
    rows = [(1, "the river", None, None, None), (None, "Fluß 漢", None, "s", 7), (3, None, None, "s", None), (4, "12 !", None, "s", 4)]
    rows += [rows[0]]
    got = corpus_pipeline.language(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert Counter(tuple(r) for r in got) == Counter([rows[0], rows[1], rows[0]])
