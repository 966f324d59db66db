"""Language-model scoring against a model with exact counts, and both ways of asking."""

import math
import random
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regbook.llm import lm_scoring as lm
from regbook.llm import queries
from regbook.llm.common import row_key, table
from regbook.storage import materialise

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), "end"]


def exact(train):
    words, pairs = Counter(), Counter()
    for text in train:
        own = tokens(text)
        words.update(own)
        pairs.update(zip(["end", *own], own))
    return words, pairs


def base(text, words):
    n, v = sum(words.values()), len(words)
    return sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens(text))


def level(count):
    return 0 if count == 0 else max(i + 1 for i, x in enumerate(lm.THRESHOLDS) if x <= count)


def quantised(train):
    """The model without the filter's wrong answers."""
    words, pairs = exact(train)
    means = []
    for counts in (words, pairs):
        by_level = {}
        for c in counts.values():
            by_level.setdefault(level(c), []).append(c)
        means.append({0: 0.0} | {k: sum(v) / len(v) for k, v in by_level.items()})
    n, v = sum(words.values()), len(words)
    m = max(1.0, len(pairs) / max(1, len(words)))

    def score(text):
        own = tokens(text)
        total = 0
        for before, word in zip(["end", *own], own):
            cb, cw = (means[0][level(words[x])] for x in (before, word))
            together = min(means[1][level(pairs[before, word])], cb)
            total += math.log10((together + m * (cw + 1) / (n + v + 1)) / (cb + m))
        return total

    return score


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgß", k=rng.randint(1, 3))) for _ in range(120)]
    rows = [" ".join(rng.choices(words, weights=range(120, 0, -1), k=rng.randint(1, 150))) for _ in range(120)]
    return [*rows, rows[0], rows[0].upper(), "", None, " \t\n", "a " * 30_000, "x\x1cy \x85 z", rows[3]]


@pytest.fixture(scope="module")
def scored(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    model = lm.train(docs.filter("doc_id % 3 != 0"))
    return docs, model, {r[0]: r[1:] for r in lm.score(docs, model).collect()}


def test_counts_and_base_are_exact(texts, scored):
    _, model, got = scored
    words, pairs = exact(t for i, t in enumerate(texts) if i % 3)
    assert (model.numbers.n_tokens, model.numbers.n_words) == (sum(words.values()), len(words))
    assert model.numbers.followers == pytest.approx(len(pairs) / len(words))
    for i, text in enumerate(texts):
        n, known, base_score, _ = got[i]
        assert n == len(tokens(text)) and known == sum(words[t] > 0 for t in tokens(text))
        assert base_score == pytest.approx(base(text, words))


def test_scores_follow_the_quantised_counts(texts, scored):
    score = quantised([t for i, t in enumerate(texts) if i % 3])
    off = [(scored[2][i][3] - score(t)) / len(tokens(t)) for i, t in enumerate(texts)]
    # Wrong answers of the filter make a part of the grams a level too frequent; of short
    # texts that can be half of them.
    assert np.mean(np.abs(off)) < 0.02
    assert max(abs(o) for o, t in zip(off, texts) if len(tokens(t)) > 20) < 0.1


def test_shards_give_the_same_scores(spark, texts, scored):
    docs, model, got = scored
    other = {r[0]: r[1:] for r in lm.score(docs, model, limit=0).collect()}
    assert other.keys() == got.keys()
    for i, row in got.items():
        assert other[i][:2] == row[:2] and other[i][2:] == pytest.approx(row[2:])


@pytest.mark.parametrize("limit", [lm.BROADCAST_BYTES, 0])
def test_many_shards(spark, texts, scored, monkeypatch, limit):
    docs, _, got = scored
    monkeypatch.setattr(lm, "SHARD_BYTES", 1 << 12)
    model = lm.train(docs.filter("doc_id % 3 != 0"))
    assert model.numbers.bits > 3 and model.shards.count() > 8
    for row in lm.score(docs, model, limit=limit).collect():
        assert row[1:3] == got[row[0]][:2]
        assert row[3] == pytest.approx(got[row[0]][2])
        assert abs(row[4] - got[row[0]][3]) < 2 + 0.05 * row[1]


def test_no_level_is_missed():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2))
    counts = (rng.pareto(1.0, len(hashes)) + 1).astype(np.int64)
    row = lm._shard_row(0, [(False, lm.pack(hashes), lm._pack_counts(counts)), (True, lm.pack(hashes[:0]), b"")])
    held = lm.Filter(0)
    held.add(0, row["bits"], row["n_bits"], row["words"], row["word_counts"])
    held.ready()
    levels = np.searchsorted(lm.THRESHOLDS, counts, side="right")
    assert (held.levels(hashes) >= levels).all() and (held.levels(hashes) > levels).mean() < 0.06
    assert (held.word_counts(hashes) == counts).all()
    others = rng.integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert (held.levels(others) > 0).mean() < 0.06 and not held.word_counts(others).any()


def test_packing():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 1000):
        hashes = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (lm.unpack(lm.pack(hashes)) == hashes).all()
        counts = rng.integers(1, 1 << 40, n)
        assert (lm._unpack_counts(lm._pack_counts(counts), n) == counts).all()


@pytest.mark.parametrize("limit", [lm.BROADCAST_BYTES, 0])
def test_nulls_empty_tables_and_extra_columns(spark, limit):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, None), (2, "a b")], "doc_id long, text string")
    for name in ("key0", "shard", "kept0", "a.b", "score", "n_tokens"):
        docs = docs.withColumn(name, F.lit("x"))
    model = lm.train(docs)
    got = sorted((tuple(r) for r in lm.score(docs, model, keep=("doc_id", "a.b"), limit=limit).collect()), key=repr)
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(1, "x", 1, 1), (1, "x", 1, 1), (2, "x", 3, 3), (None, "x", 3, 3)]
    assert lm.score(docs.limit(0), model, limit=limit).count() == 0
    for row in lm.score(docs, lm.train(docs.limit(0)), limit=limit).collect():
        assert row["n_known"] == 0 and row["base_score"] == 0 and row["score"] == 0


def test_groups_ask_each_shard_once(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_BYTES", 1 << 12)
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefghijk", k=40)) for _ in range(400)] * 2
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    rows = docs.select(*[k.alias(f"key{i}") for i, k in enumerate(row_key("text"))], "text")
    groups, asked = lm._questions(rows, 4)
    held = Counter()
    by_group = {}
    for row in groups.collect():
        by_group.setdefault(row["group"], []).append(row)
        held[row["group"]] += 1
    wanted = {}
    for group, blocks in by_group.items():
        _, own = lm._texts_of(pa.Table.from_pylist([b.asDict() for b in blocks], schema=lm.GROUPS_TYPE))
        wanted[group] = [t.decode() for t in own]
    # Every distinct text is in one group, and once.
    assert sorted(t for own in wanted.values() for t in own) == sorted(set(texts)) and len(wanted) > 5
    rows = asked.collect()
    # One question a group and shard, not a text and shard, with all grams of the group.
    assert len(rows) == len({(r["group"], r["shard"]) for r in rows}) <= 16 * len(wanted)
    for group, own in wanted.items():
        grams = {g for t in own for g in (*tokens(t), *zip(["end", *tokens(t)], tokens(t)))}
        found = [h for r in rows if r["group"] == group for n in ("words", "pairs") for h in lm.unpack(r[n]).tolist()]
        assert len(found) == len(set(found)) == len(grams)
        assert all(h >> 60 == r["shard"] for r in rows if r["group"] == group for h in lm.unpack(r["pairs"]).tolist())


def test_many_groups_and_questions_in_parts(spark, texts, scored, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 1 << 12)
    for name, value in (("GROUP_BYTES", 1 << 12), ("DEAL_BYTES", 1 << 11), ("QUESTIONS", 50), ("MEMORY", 3)):
        monkeypatch.setattr(lm, name, value)
    docs, _, _ = scored
    model = lm.train(docs.filter("doc_id % 3 != 0"))
    got, other = ({r[0]: r[1:] for r in lm.score(docs, model, limit=limit).collect()} for limit in (0, lm.BROADCAST_BYTES))
    assert got.keys() == other.keys() and len(got) == len(texts)
    for i, row in got.items():
        assert row[:2] == other[i][:2] and row[2:] == pytest.approx(other[i][2:])


def test_hashes_follow_the_words():
    rng = random.Random(6)
    alphabet = [b"\0", b"a", b"B", "\u00e9".encode(), b"\xff", b"\x1c", b"\x85", b" ", b"\n", b"\x0b", b"\x0c", b"\r", b"\t"]
    long = [b"a" * n for n in (7, 8, 9, 15, 16, 17, 63, 64, 65, 72, 200, 5000)] + [b"a" * 64 + b"b", b"b" + b"a" * 64]
    texts = [b"", b" ", b"a\0", b"a", b"\0", b" ".join(long), b" ".join(long[::-1]).upper()]
    texts += [b"".join(rng.choices(alphabet, weights=[3] * 7 + [1] * 6, k=rng.randint(0, 120))) for _ in range(300)]
    flat, sizes = lm.tokens(texts)
    words = [w for t in texts for w in [*t.lower().split(), None]]
    assert sizes.tolist() == [len(t.split()) + 1 for t in texts] and len(flat) == len(words)
    known = dict(zip(words, flat.tolist()))
    assert known[None] == lm.END and [known[w] for w in words] == flat.tolist()
    assert len(set(known.values())) == len(known)
    # The same whatever stands beside them.
    for text in texts[:60]:
        assert lm.tokens([text])[0].tolist() == [known[w] for w in [*text.lower().split(), None]]
    assert [len(x) for x in lm.tokens([])] == [0, 0]


def test_shuffles_are_dropped_when_written(spark):
    folder = Path(spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf()))

    def files():
        return set(folder.parent.glob("blockmgr-*/*/shuffle_*.data"))

    before, wanted = files(), list(range(1000))
    df = spark.range(1000).repartition(3, "id")
    assert sorted(r[0] for r in materialise(df, "kept").collect()) == wanted
    kept = files()
    assert sorted(r[0] for r in materialise(df, "dropped", drop_shuffles=True).collect()) == wanted
    assert kept - before
    # Spark takes them away in the background.
    for _ in range(100):
        if not files() - kept:
            break
        time.sleep(0.1)
    assert not files() - kept
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_query(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    held = {r[0] for r in docs if zlib.crc32(str(r[0]).encode()) % 7 == 2}
    words, _ = exact(t for i, t in docs if i not in held)
    rows = queries.op11_lm_scoring(spark, FOLDER).collect()
    assert len(rows) == len(docs) and {r["doc_id"] for r in rows if r["held_out"]} == held
    text = dict(docs)
    for r in rows:
        assert r["train_tokens"] == sum(words.values()) and r["n_tokens"] == len(tokens(text[r["doc_id"]]))
        assert r["base_score"] == pytest.approx(base(text[r["doc_id"]], words))
    # Held-out texts are more likely under the model than by word counts alone.
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
