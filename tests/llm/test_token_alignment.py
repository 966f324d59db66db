"""Alignment against encoding every whole text, with all pairs counted in one place."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from regbook.llm import queries
from regbook.llm import token_alignment as ta
from regbook.llm.common import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models():
    return ta.Models.load(queries.BYTE_LEVEL, queries.PIECES)


def brute_force(texts):
    """Measures of every text, by whole encodings and prefix bytes."""
    a = Tokenizer.from_file(queries.BYTE_LEVEL)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=queries.PIECES)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown}
    byte |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    token = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab().items()}
    piece = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.vocab_size())]
    found, links = [], []
    for text in texts:
        own, groups = [], []
        ours, theirs = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        ends = {}
        if text and all(b"".join(x) == (" " + text).encode() for x in ([token[i] for i in ours], [piece[i] for i in theirs])):
            for side, ids, raw in ((0, ours, token), (1, theirs, piece)):
                at = 0
                for i in ids:
                    at += len(raw[i])
                    ends.setdefault(at, [None, None])[side] = i
            open_ = ([], [])
            for at in sorted(ends):
                for side in (0, 1):
                    if ends[at][side] is not None:
                        open_[side].append(str(ends[at][side]))
                if None not in ends[at]:
                    own.append(tuple(ends[at]))
                    groups.append("|".join(",".join(x) for x in open_))
                    open_ = ([], [])
        else:
            ours, theirs = [], []
        links.append(own)
        text = ";".join(groups)
        found.append([len(ours), len(theirs), len(groups), len(own), hashlib.sha256(text.encode()).hexdigest() if text else ""])
    counts = Counter(x for own in links for x in own)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (*f[:4], sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), f[4])
        for f, own in zip(found, links)
    ]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(9)
    odd = "ab é中▁\n\t  ''sS.1²-　​\x85\x1c🙂́ﬁ\xa0 "
    rows = [r[0] for r in table(spark, FOLDER, "documents").select("text").limit(60).collect()]
    rows += ["".join(rng.choices(odd, k=rng.randint(1, 25))) for _ in range(300)]
    rows += ["<|endoftext|> a <|endoftext|>", " " * 40 + "a", "it's we'll  o'ne", "", None, "▁", "a b", "a b", rows[0], rows[0]]
    return [*rows, "x" * 50_000, " " * 20_000, "word " * 20_000]


@pytest.mark.parametrize("most", [ta.PAIRS, 100, 0])
def test_against_whole_texts(spark, models, texts, most):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in ta.align(docs, models, most=most).collect()}
    for i, expected in enumerate(brute_force(texts)):
        assert got[i] == expected, (i, texts[i][:80] if texts[i] else texts[i])


def test_groups_written_out(spark, models):
    rows = spark.createDataFrame([("It's a test.",), ("",)], "text string")
    got = ta.align_texts(rows, models, groups=True).collect()
    assert hashlib.sha256(got[0]["groups"].encode()).hexdigest() == got[0]["groups_sha256"]
    assert len(got[0]["groups"].split(";")) == got[0]["n_groups"] == got[0]["n_links"] and got[1]["groups"] == ""


def test_words_are_cut_where_both_tokenizers_cut(models):
    aligner = ta.Aligner(models)
    for text in ("a b", "a  b c", "a\n b c", " a", "a ", "a\x1c b", "a ​b c"):
        assert "".join(ta.words_of(text)) == " " + text
    assert ta.words_of("a b c") == [" a", " b", " c"] and ta.words_of("a  b") == [" a  b"]
    aligner.learn([" a"])
    assert aligner.known[" a"][:2] == (1, 1)


def test_nulls_empty_tables_and_extra_columns(spark, models):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, None), (2, "a b")], "doc_id long, text string")
    for name in ("key0", "copies", "kept0", "a.b", "code", "n_a"):
        docs = docs.withColumn(name, F.lit("x"))
    got = ta.align(docs, models, keep=("doc_id", "a.b"))
    rows = sorted((tuple(r)[:6] for r in got.collect()), key=repr)
    assert rows == [(1, "x", 0, 0, 0, 0), (1, "x", 0, 0, 0, 0), (2, "x", 2, 2, 2, 2), (None, "x", 2, 2, 2, 2)]
    assert ta.align(docs.limit(0), models).count() == 0


def test_query(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in ta.OUT) for r in queries.op12_token_alignment(spark, FOLDER).collect()}
    expected = brute_force([t for _, t in docs])
    assert got == {i: e for (i, _), e in zip(docs, expected)}
