"""Every operator against brute force, and on nulls, empty tables, repeated rows and
columns with clashing names."""

import collections
import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from regbook.llm import (
    components,
    decontamination,
    html_extraction,
    language_model,
    line_dedup,
    pii,
    quality_rules,
    sentencepiece,
    simhash,
    suffix_dedup,
    token_counts,
)
from regbook.llm.common import table
from regbook.llm.queries import PIECES, RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = " \t\n\x0b\x0c\r"


def make(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, None)[:5] for r in rows] if schema == SCHEMA else rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(300)]
    text = [" ".join(rng.choices(words, k=rng.randint(30, 200))) for _ in range(40)]
    rows = [(i, t + "\n" + text[0] * (i % 3 == 0), "en", f"s{i % 2}", 1) for i, t in enumerate(text)]
    rows += [(50, text[1] + " x", "en", "s1", None), (51, text[1].upper(), None, None, None)]
    rows += [(60, None, None, None, None), (61, "", "en", "s1", 0), (62, " \t\n", "en", "s1", 0)]
    rows += [(None, text[2], "en", "s1", 1), (None, None, None, None, None), (None, "solo " * 60, "de", "s9", 1)]
    rows += [(70, "a " * 50_000, "en", "s1", 1), (7, rows[7][1], "en", "s1", 1), (8, "other text", "en", "s1", 1)]
    return make(spark, rows)


@pytest.fixture
def empty(spark):
    return make(spark, [])


def test_components_by_union_find(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(-50, 50), rng.randint(-50, 50)) for _ in range(60)] + [(i, i + 1) for i in range(200, 240)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    expected = {(x, find(x)) for x in parent if find(x) != x}
    got = components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("max_bits", [0, 2, 3])
@pytest.mark.parametrize("bucket", [2, 32])
def test_simhash_links_as_all_pairs_do(spark, monkeypatch, max_bits, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(2)
    prints = {0}
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(6):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            prints.add(base)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    roots = dict(map(tuple, components.connected_components(simhash.links(df, max_bits)).collect()))
    group = {p: p for p in prints}
    for a, b in itertools.combinations(prints, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits and group[a] != group[b]:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {p: new if g == old else g for p, g in group.items()}
    assert {p: roots.get(p, p) for p in prints} == group


def test_simhash_rows(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    found = simhash.near_duplicates(odd).collect()
    assert sorted((r.doc_id or -1, r.fingerprint) for r in found) == sorted(
        (r.doc_id or -1, brute_print(r.text)) for r in rows
    )
    kept = simhash.keep_first(odd).collect()
    component = {r.fingerprint: (r.root, r.component_id) for r in found}
    assert len(kept) == len({root for root, _ in component.values()})
    assert all(component[brute_print(r.text)][1] == r.doc_id for r in kept)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


@pytest.mark.parametrize("batches, fanout", [(1, 4), (4, 2), (9, 2), (9, 3)])
def test_line_dedup(odd, empty, batches, fanout):
    data = odd.withColumn("n_lines", F.lit(9)).withColumn("text", F.concat("text", F.lit("\n  Same Line\t")))
    docs = collections.defaultdict(set)
    rows = data.select("doc_id", "text").collect()
    key = lambda line: line.strip(SPACES).lower()
    for r in rows:
        for line in (r.text or "").split("\n"):
            docs[key(line)].add(r.doc_id if r.doc_id is not None else (r.text,))
    expected = []
    for r in rows:
        lines = (r.text or "").split("\n")
        left = [x for x in lines if not (key(x) and len(docs[key(x)]) >= 4)]
        expected.append((r.doc_id or -1, "\n".join(left), len(lines), len(lines) - len(left)))
    for name in ("_id", "_text", "_dropped", "_kept", "a.b"):
        data = data.withColumn(name, F.lit("x"))
    got = line_dedup.drop_frequent_lines(data, min_docs=4, batches=batches, fanout=fanout)
    assert got.columns == [*data.columns[:-6], *[c for c in data.columns[-6:] if c != "n_lines"], "n_lines", "n_dropped"]
    assert sorted((r.doc_id or -1, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == sorted(expected)
    assert line_dedup.drop_frequent_lines(empty).count() == 0


def test_quality_counts_and_verdicts(spark, odd, empty):
    judged = {(r.doc_id, r.text_key): r for r in quality_rules.judge(odd).collect()}
    for r in odd.withColumn("k", F.xxhash64("text")).collect():
        words = (r.text or "").translate({ord(c): " " for c in SPACES}).split(" ")
        words = [w for w in words if w]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = collections.Counter(windows)
        again = len({i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)})
        lines = [x for x in (r.text or "").split("\n") if x.strip(SPACES)]
        got = judged[r.doc_id, r.k]
        assert (got.n_words, got.word_chars, got.n_repeat_words, got.n_dup_lines) == (
            len(words), sum(map(len, words)), again, len(lines) - len(set(lines))
        )
        assert got.base_failed == (len(words) < 50 or 2 * again > len(words))
        assert not (got.kept and got.base_failed)
    assert quality_rules.judge(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(2000)]
    plain = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 300))), "en", "a") for i in range(300)]
    noisy = [(1000 + i, " ".join(w + "$$%#" for w in rng.choices(vocabulary, k=90)), "en", "a") for i in range(60)]
    docs = spark.createDataFrame(plain + noisy, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.keep_good(docs).collect()}
    assert not kept & {i for i, *_ in noisy} and len(kept) >= 0.98 * len(plain)


def test_contamination(spark, odd, empty):
    item = "Yesterday the driver named Alice went along the river for 120 km in 3 hours on Monday and wants to know how fast the car of Alice was going"
    again = item.replace("120", "480").replace("3", "6").replace("Alice", "Robert").replace("Monday", "Friday")
    broken = again.replace("of Robert", "of Peter")
    benchmark = make(spark, [(1, item), (2, None), (None, ""), (1, item)], "item_id long, text string")
    docs = make(
        spark,
        [(1, f"intro here. {item} and more"), (2, f"so {again} done"), (3, f"so {broken} done"), (4, "no match " * 40)],
        "doc_id long, text string",
    )
    for block in (3, 4_000_000):
        got = {r.doc_id: r for r in decontamination.contaminated(docs, benchmark, block=block).collect()}
        assert set(got) == {1, 2, 3} and got[1].same_slots and not got[2].same_slots
        assert got[3].n_windows < got[2].n_windows
    left = decontamination.drop_contaminated(docs.withColumn("bad", F.lit(1)), benchmark)
    assert {r.doc_id for r in left.collect()} == {4}
    assert decontamination.drop_contaminated(odd, benchmark).count() == odd.count()
    assert decontamination.contaminated(empty, benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.limit(0)).count() == 0


def brute_contamination(docs, items):
    """All pairs of texts, window by window, with the same words and templates."""
    out = {}
    texts = [t for _, t in docs] + [t for _, t in items]
    words = decontamination.Words()
    parts = list(words.templates(texts))
    size, plain = decontamination.WINDOW, decontamination.MIN_PLAIN
    cut = lambda h, k: {
        i for i in range(len(h) - size + 1) if sum(x == 0 for x in k[i : i + size]) >= plain
    }
    for (doc, _), (dh, dv, dk) in zip(docs, parts):
        for (item, _), (ih, iv, ik) in zip(items, parts[len(docs) :]):
            doc_windows, item_windows = cut(dh, dk), cut(ih, ik)
            runs = collections.defaultdict(list)
            for j in item_windows:
                for i in doc_windows:
                    if list(dh[i : i + size]) == list(ih[j : j + size]):
                        runs[i - j].append((i, [(dv[i + x], iv[j + x]) for x in range(size) if dk[i + x] != 0]))
            if not item_windows and len(iv):
                for i in range(len(dv) - len(iv) + 1):
                    if list(dv[i : i + len(iv)]) == list(iv):
                        runs[i].append((i, []))
            best = 0
            for windows in runs.values():
                pairs = {p for _, slots in windows for p in slots}
                d, k = collections.Counter(p[0] for p in pairs), collections.Counter(p[1] for p in pairs)
                fine = [i for i, s in windows if all(a == b for a, b in s) or all(d[a] == 1 == k[b] for a, b in s)]
                best = max(best, len(set(fine)))
            if best:
                out[doc, item] = best
    return out


def test_contamination_is_what_all_pairs_give(spark):
    rng = random.Random(12)
    plain = "the a river went fast along and wants to know how far it is from here".split()
    slots = ["120", "3", "7.5", "km", "hours", "kg", "Alice", "Robert", "Paris", "Monday"]

    def sentence(n):
        return [rng.choice(slots) if rng.random() < 0.2 else rng.choice(plain) for _ in range(n)]

    items = [(i, sentence(rng.choice([3, 5, 7, 9, 15, 30]))) for i in range(25)]
    docs = []
    for i in range(80):
        body = list(rng.choice(items)[1])
        for at in range(len(body)):
            if body[at] in slots and rng.random() < 0.25:
                body[at] = rng.choice(slots)
        docs.append((i, " ".join(sentence(rng.randint(0, 20)) + body + sentence(rng.randint(0, 20)))))
    items = [(i, " ".join(t)) for i, t in items] + [(90, ""), (91, "12 kg plus 7 kg minus 3 kg plus 5 kg is what?")]
    items += [(92, "What is the capital of France?")]
    docs += [(200, "He asked: what is the capital of France? Nobody knew."), (201, f"so {items[-2][1]} indeed"), (202, "")]
    got = decontamination.contaminated(
        make(spark, docs, "doc_id long, text string"), make(spark, items, "item_id long, text string")
    ).collect()
    expected = brute_contamination(docs, items)
    assert {(r.doc_id, r.item_id): r.n_windows for r in got} == expected
    assert {(200, 92), (201, 91)} <= set(expected)


def test_altered_copies_stay_copies(spark):
    words = [f"word{chr(97 + i)}" for i in range(20)]
    item = " ".join([*words, "Alice", "paid", "120", "euros", *words[:10], "and", "then", "Alice", "got", "3", *words[10:]])
    altered = [item.replace("then Alice", "then Robert"), item.replace("120", "3")]
    found = decontamination.contaminated(
        make(spark, list(enumerate(altered)), "doc_id long, text string"), make(spark, [(1, item)], "item_id long, text string")
    )
    assert {r.doc_id for r in found.collect()} == {0, 1}


def test_long_blank_runs(spark):
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    from sentencepiece import SentencePieceProcessor

    library, encoder = SentencePieceProcessor(model_file=PIECES), sentencepiece.Encoder(vocabulary)
    start = time.perf_counter()
    (got,) = encoder.encode(["▁" * 100_001])
    assert time.perf_counter() - start < 5 and list(got) == library.encode(" " * 100_000)
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choices("▁▁▁▁ab", k=rng.randint(1, 40)))
        assert encoder.merge(text) == slow_merge(vocabulary, text)


def test_pieces_side_by_side():
    """Whether two pieces stay apart, told from how each is made, and by merging both."""
    encoder = sentencepiece.Encoder(sentencepiece.Vocabulary.load(PIECES))
    rng = random.Random(17)
    usable = [p for p, i in sorted(encoder.v.ids.items()) if encoder._stable(p, i)]
    short = [p for p in usable if len(p) < 4]
    blanks = [p for p in usable if not p.strip("▁")]
    apart = 0
    for i in range(60_000):
        pool = (usable, short, blanks)[i % 3]
        left, right = rng.choice(pool), rng.choice(short if i % 2 else pool)
        if set(left) == {"▁"} and right.startswith("▁"):
            continue  # runs of blanks are merged as a whole
        expected = encoder.merge(left + right) == [left, right]
        assert encoder.separate(left, right) == expected, (left, right)
        apart += expected
    assert apart > 1000


def slow_merge(vocabulary, text):
    parts = list(text)
    while True:
        found = [(-vocabulary.scores[vocabulary.ids[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in vocabulary.ids]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_vocabularies_do_not_share_an_encoder():
    one = sentencepiece.Vocabulary(["▁a", "a", "▁"], [0.0, 0.0, 0.0], {}, True, [True] * 3)
    other = sentencepiece.Vocabulary(["▁a", "a", "▁"], [-9.0, 0.0, 0.0], {}, True, [True] * 3)
    assert sentencepiece._encoder(one) is not sentencepiece._encoder(other)


def test_sentencepiece_equals_the_library(spark, odd, empty):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECES)
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    rng = random.Random(3)
    texts = ["".join(rng.choices("abe thern  \nåß日本👍%$#12 ,.'\t", k=rng.randint(0, 80))) for _ in range(300)]
    docs = odd.select("doc_id", "text").union(make(spark, list(enumerate(texts)), "doc_id long, text string"))
    decoded = sentencepiece.decode(sentencepiece.encode(docs.withColumn("ids", F.lit(1)), vocabulary), vocabulary)
    for r in decoded.collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "")
    assert sentencepiece.encode(empty, vocabulary).count() == 0


def piece_batch(texts):
    return pa.record_batch({"carried": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def test_pieces_of_words_walked_together(monkeypatch):
    """Ordinary words never go one by one; long ones, runs of blanks, marks in the text and
    characters without a piece give what the library gives."""
    from sentencepiece import SentencePieceProcessor

    library, vocabulary = SentencePieceProcessor(model_file=PIECES), sentencepiece.Vocabulary.load(PIECES)
    alone, one_by_one = [], sentencepiece.Encoder.encode_sorted

    def seen(self, words):
        alone.extend(words)
        return one_by_one(self, words)

    monkeypatch.setattr(sentencepiece.Encoder, "encode_sorted", seen)
    monkeypatch.setattr(sentencepiece, "SLICE_BYTES", 100_000)
    rng = random.Random(23)
    pieces, letters = sorted(vocabulary.ids), sorted({c for p in vocabulary.ids for c in p} | set("👍\x00\u0378"))
    texts = [" ".join("".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(20)) for _ in range(1500)]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(rng.choices("abth  ▁\n\n👍", k=rng.randint(0, 12))) for _ in range(1500)]
    texts += [None, "", "\n", " ", "▁", "日本語" * 900, "th" * 200 + "\u0378"]
    texts += ["".join(rng.choices(letters[500:], k=rng.randint(300, 400))) for _ in range(60)]
    batch = piece_batch(texts)
    parts = list(sentencepiece._encode_batches(iter([batch.slice(0, 1), batch.slice(1), batch.slice(0, 0)]), vocabulary))
    got = [ids for part in parts for ids in part.column(2).to_pylist()]
    assert len(parts) > 3 and got == [library.encode((t or "").replace("▁", " ")) for t in texts]
    assert all(w.startswith("▁▁") or len(w) > sentencepiece.LONG for w in alone)


def test_workers_keep_no_words(monkeypatch):
    """What an encoder remembers does not grow with the words it has met."""
    monkeypatch.setattr(sentencepiece, "_encoders", {})
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    rng = random.Random(31)
    texts = [" ".join("".join(rng.choices("etaoinshr", k=6)) for _ in range(200)) for _ in range(300)]
    assert sum(p.num_rows for p in sentencepiece._encode_batches(iter([piece_batch(texts)]), vocabulary)) == 300
    encoder = sentencepiece._encoder(vocabulary)
    assert not (encoder.known or encoder.older or encoder.fits)
    arrays = [a for o in (encoder.walk, encoder.walk.next, encoder.walk.joined) for a in vars(o).values() if isinstance(a, np.ndarray)]
    assert sum(a.nbytes for a in arrays) < 24e6


def test_decoding_in_parts(spark, monkeypatch):
    """Long batches are decoded part by part, and piece numbers go to the worker once."""
    monkeypatch.setattr(sentencepiece, "SLICE_BYTES", 4000)
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    rng = random.Random(37)
    usable, byte = sorted(vocabulary.ids.values()), vocabulary.byte_ids
    blank = vocabulary.ids["▁"]
    lists = [rng.choices(usable, k=rng.randint(0, 40)) for _ in range(300)]
    lists += [None, [], [blank], [blank, blank], [byte[0xE2]], [blank, byte[0xF0], byte[0x9F], usable[300]], [0], [0, blank]]
    batch = pa.record_batch({"carried": pa.array(range(len(lists))), "ids": pa.array(lists, pa.list_(pa.int32()))})
    pieces = {i: p.replace("▁", " ").encode() for p, i in vocabulary.ids.items()} | {i: bytes([b]) for b, i in byte.items()}
    expected = [b"".join(pieces.get(i, b"") for i in ids or []).removeprefix(b" ").decode("utf-8", "replace") for ids in lists]
    parts = list(sentencepiece._decode_batches(iter([batch.slice(0, 5), batch.slice(5)]), vocabulary))
    assert [t for p in parts for t in p.column(2).to_pylist()] == expected
    assert len(parts) > 4 and all(len(p.column(1).flatten()) < 1100 for p in parts)

    rows = spark.createDataFrame([(1, "x", [blank, usable[300]])], "doc_id long, b string, ids array<int>")
    decoded = sentencepiece.decode(rows, vocabulary)
    assert decoded.columns == ["doc_id", "b", "ids", "decoded"]
    assert tuple(decoded.first()) == (1, "x", [blank, usable[300]], vocabulary.pieces[usable[300]].replace("▁", " "))
    plan = decoded._jdf.queryExecution().analyzed().toString()
    (sent,) = re.findall(r"struct\(([^)]*)\) AS carried", plan)
    assert "ids" not in sent


def test_pairs_apart_in_arrays():
    encoder = sentencepiece.Encoder(sentencepiece.Vocabulary.load(PIECES))
    rng = random.Random(29)
    numbers = [i for p, i in sorted(encoder.v.ids.items()) if encoder._stable(p, i)]
    common = numbers[:: len(numbers) // 400] + [i for i in numbers if len(encoder.v.pieces[i]) < 3][:400]
    left, right = ([rng.choice((numbers, common)[i % 2]) for i in range(60_000)] for _ in range(2))
    expected = [encoder.separate(encoder.v.pieces[a], encoder.v.pieces[b]) for a, b in zip(left, right)]
    assert encoder.walk.apart(np.array(left, np.int32), np.array(right, np.int32)).tolist() == expected
    assert 1000 < sum(expected) < 59_000
    for _ in range(2):
        assert encoder.walk._fit(np.array(left, np.int32), np.array(right, np.int32)).tolist() == expected


def test_unigram_is_the_best_split():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "bab"]
    scores = [-2.0, -3.0, -3.5, -4.0, -3.2, -4.4, -5.0]
    vocabulary = sentencepiece.Vocabulary(pieces, scores, {}, True, [True] * 7)
    words = sorted({"▁" + "".join(w) for n in range(1, 6) for w in itertools.product("ab", repeat=n)})

    def best(word):
        if not word:
            return 0.0
        return max(scores[pieces.index(p)] + best(word[len(p) :]) for p in pieces if word.startswith(p))

    for word, ids in zip(words, sentencepiece.Encoder(vocabulary).encode_sorted(words), strict=True):
        assert "".join(pieces[i] for i in ids) == word
        assert sum(scores[i] for i in ids) == pytest.approx(best(word))


def test_html(spark):
    page = (
        "<html><head><title>No</title></head><body><nav><ul>" + "<li><a href='/x'>menu item</a></li>" * 6
        + "</ul></nav><div class='ad'>buy this</div>{open}<h1>Head &amp; more</h1><p><b>First\n part.<br>Next"
        "<p>Second &lt;here&gt;</p><form>mail <input></form><p>End.</p>{close}<footer>&copy; all of us here</footer></body></html>"
    )
    marked = page.format(open="<article>", close="</article>")
    rows = [(i, "u", marked.replace("part", f"part {i}")) for i in range(20)]
    rows += [(30, "u", page.format(open="<div id=x>", close="</div>")), (31, None, None), (32, "u", ""), (None, "u", "<p>bare text")]
    got = {r.page_id: r.text for r in html_extraction.main_text(make(spark, rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Head & more First part 3. Next Second <here> End."
    assert got[30] == "Head & more First part. Next Second <here> End."
    assert (got[31], got[32], got[None]) == ("", "", "bare text")
    best = lambda s: max((sum(s[i:j]) for i in range(len(s) + 1) for j in range(i, len(s) + 1)))
    rng = random.Random(6)
    for _ in range(200):
        scores = [rng.choice([-2.0, -1.0, 1.0, 2.0]) for _ in range(rng.randint(0, 12))]
        start, end = html_extraction.best_region(scores)
        assert sum(scores[start:end]) == best(scores)


def test_pii(spark, odd, empty):
    def brute(text):
        found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        found += [
            (m.start(), 1, m.end())
            for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))
        ]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = [int(c) for c in m[0] if c.isdigit()][::-1]
            total = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
            if 14 <= len(digits) <= 19 and total % 10 == 0:
                found.append((m.start(), 2, m.end()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
        return [(s, e, pii.BASE_KINDS[k]) for s, k, e in sorted(found)]

    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choices(["a", "@", ".", "1", "23", "0", "-", " ", "+", "(", ")", "com", "4539578763621486", "é"], k=25))
        assert pii.base_spans(text) == brute(text)
    secrets = [(100 + i, f'word token = "{hashlib.sha1(bytes([i])).hexdigest()}" end', None, None) for i in range(30)]
    docs = odd.union(make(spark, secrets + [(200, "mail a.b@c.org or +1 (017) 555-7713", None, None)]))
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert got[60].spans == "" and got[200].base_spans == got[200].spans == "email:5:14,phone:18:35"
    assert sum("secret" in got[100 + i].spans for i in range(30)) >= 28
    assert pii.find_personal_data(empty).count() == 0


def test_substrings(spark, odd, empty, monkeypatch):
    rng = random.Random(9)
    shared = "".join(rng.choices("abcdeé ", k=160))
    extra = [(300 + i, "".join(rng.choices("xyz ", k=70)) + shared[i : i + 60 + 9 * i] + "tail", None, None) for i in range(12)]
    docs = odd.union(make(spark, extra))
    rows = docs.select("doc_id", "text").collect()
    key = lambda r: suffix_dedup.LAST if r.doc_id is None else r.doc_id
    first, expected = {}, []
    for r in sorted(rows, key=key):
        data = (r.text or "").encode()
        for i in range(len(data) - 49):
            first.setdefault(data[i : i + 50], key(r))
    for r in rows:
        data = (r.text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < key(r):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        expected.append((r.doc_id or -1, kept, len(data), sum(gone), len(re.findall(b"\1+", gone))))
    for hot in (2, 10_000):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        monkeypatch.setattr(suffix_dedup, "CHUNK", 400 if hot == 2 else 1 << 21)
        got = suffix_dedup.drop_repeated_substrings(docs).collect()
        assert sorted((r.doc_id or -1, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got) == sorted(expected)
    assert suffix_dedup.drop_repeated_substrings(empty).count() == 0


def test_token_counts(spark, odd, empty):
    ranks = token_counts.load_ranks(RANKS)
    counter = token_counts.Counter(ranks)
    full = lambda text: len(counter.encoding.encode_ordinary(text or ""))
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices("ab the's  \n\té日12 ,.", k=rng.randint(0, 900)))
        tree = counter.tree(text)
        for _ in range(4):
            places = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.choice([1, 1, 2, 6])))
            edits = [
                (start, rng.choice([start, min(end, start + 1), end]), "".join(rng.choices("a's \n1", k=rng.choice([0, 1, 40, 3000]))))
                for start, end in zip(places[::2], places[1::2])
            ]
            expected = text
            for start, end, put in reversed(edits):
                expected = expected[:start] + put + expected[end:]
            text, tree, _ = counter.edit(text, tree, edits)
            assert text == expected
            assert tuple(tree[1]) == (len(text), full(text), len(counter.split(text)))
    counted = token_counts.count_tokens(odd.withColumn("tree", F.lit(1)), ranks)
    assert all(r.n_tokens == full(r.text) for r in counted.collect())
    edits = token_counts.pattern_edits("text", ((r"[aeiou]{2,}", "-"),))
    edited = token_counts.apply_edits(counted.withColumn("edits", edits), ranks)
    assert all(r.n_tokens == full(r.text) for r in edited.collect())
    assert token_counts.count_tokens(empty, ranks).count() == 0


def test_many_edits_cost_what_they_touch():
    counter = token_counts.Counter(token_counts.load_ranks(RANKS))
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(4000))
    tree, total, size = counter.tree(text), 0, len(counter.split(text))
    for _ in range(2000):
        at = rng.randint(0, len(text) - 5)
        text, tree, n = counter.edit(text, tree, [(at, at + rng.randint(0, 3), rng.choice(["x", " yz", ""]))])
        total += n
    assert tuple(tree[1]) == (len(text), len(counter.encoding.encode_ordinary(text)), len(counter.split(text)))
    # A few leaves each, however many edits came before.
    assert total < 2000 * 5 * token_counts.LEAF
    edits = [(i, i + 1, "-") for i in range(0, len(text), 9)]
    assert counter.edit(text, tree, edits)[2] < 3 * size


def test_token_counts_with_clashing_columns(spark):
    ranks = token_counts.load_ranks(RANKS)
    rows = make(spark, [(1, "a b")], "doc_id long, text string")
    for name in ("_", "none", "carried", "a.b", "c0"):
        rows = rows.withColumn(name, F.lit("x"))
    counted = token_counts.count_tokens(rows, ranks)
    assert counted.columns == ["doc_id", "_", "none", "carried", "a.b", "c0", "text", "tree", "n_tokens"]
    edits = F.expr("array(named_struct('start', 1, 'end', 2, 'text', ' and '))")
    (row,) = token_counts.apply_edits(counted.withColumn("edits", edits), ranks).collect()
    assert (row.text, row["a.b"], row.n_tokens) == ("a and b", "x", 3)


def brute_kneser_ney(texts):
    """The model by its definition, as a function of context and character."""
    order, start, stop = language_model.ORDER, language_model.START, language_model.STOP
    grams = collections.Counter()
    for text in texts:
        padded = start * (order - 1) + re.sub("[0-9]", "0", text) + stop
        grams.update(padded[i : i + order] for i in range(len(padded) - order + 1))
    levels = {order: grams}
    for n in range(order - 1, 0, -1):
        levels[n] = collections.Counter(g[1:] for g in levels[n + 1])
    discounts = {}
    for n, counts in levels.items():
        t = [sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] else 0
        plain = [(i + 1) - (i + 2) * y * t[i + 1] / t[i] if t[i] and t[0] else -1 for i in range(3)]
        discounts[n] = [p if 0 <= p <= i + 1 else (i + 1) / 2 for i, p in enumerate(plain)]

    def probability(context, char):
        n = len(context) + 1
        if n == 1:
            lower = 1 / (len(levels[1]) + 1)
        else:
            lower = probability(context[1:], char)
        follow = {g: c for g, c in levels[n].items() if g[:-1] == context}
        if not follow:
            return lower
        taken = {g: discounts[n][min(c, 3) - 1] for g, c in follow.items()}
        total, gram = sum(follow.values()), context + char
        return (follow.get(gram, 0) - taken.get(gram, 0)) / total + sum(taken.values()) / total * lower

    return probability


def test_language_model(spark, empty):
    import math

    texts = ["the cat sat on the mat", "the dog sat on the log 42", "a cat and a dog", "mat and log and cat"]
    model = language_model.train(language_model.gram_counts(make(spark, [("en", t) for t in texts], "lang string, text string")))
    probability = brute_kneser_ney(texts)
    asked = ["the cat and the dog", "zebra 7", "log"]
    rows = make(spark, [(i, "en", i, t) for i, t in enumerate(asked)], "doc_id long, lang string, text_key long, text string")
    for shard_rows in (10**6, 40):
        got = {r.doc_id: r for r in language_model.score(rows, model, ["en"], shard_rows).collect()}
        for i, text in enumerate(asked):
            order = language_model.ORDER
            padded = language_model.START * (order - 1) + re.sub("[0-9]", "0", text) + language_model.STOP
            expected = sum(math.log(probability(padded[j - order + 1 : j], padded[j])) for j in range(order - 1, len(padded)))
            assert got[i].logp == pytest.approx(expected, rel=1e-4) and got[i].n_scored == len(text) + 1


def test_classifier(spark, odd, empty):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcde", k=rng.randint(2, 5))) for _ in range(100)]
    good = [(i, " ".join(rng.choices(words, k=80)), "en", "s") for i in range(1000, 1200)]
    bad = [(i, "".join(rng.choices("XYZ#%$&Q ", k=300)), "en", "s") for i in range(2000, 2030)]
    docs = odd.union(make(spark, good + bad))
    trusted = spark.createDataFrame([(i,) for i in range(1000, 1150)] + [(None,)], "id long")
    found = language_model.classify(docs, trusted)
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert found.count() == docs.count()
    assert not any(kept[i] for i, *_ in bad) and sum(kept[i] for i, *_ in good) >= 190
    assert not kept[60] and not kept[61]
    assert language_model.classify(empty, trusted).count() == 0
    assert not any(r.kept for r in language_model.classify(odd, trusted.limit(0)).collect())


@pytest.mark.parametrize(
    "page",
    [
        '<div class="layout has-sidebar"><h1>Kept</h1><article>Kept words</article></div>',
        '<ul><li class="menu-item">A<li class="menu-item">B</ul><article>Kept words</article>',
        '<ul><li class="menu-item">A<li>Kept words</ul>',
    ],
)
def test_html_exclusion_ends(page):
    texts = {text: content for _, text, content in html_extraction.tokens(page)}
    assert texts["Kept words"] and texts.get("Kept", True) and not texts.get("A")


MENU = "<nav><ul>" + "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("home", "news", "shop", "team", "jobs")) + "</ul></nav>"
CONTENTS = [
    ("<h1>One &amp; all</h1><p>First\n text <b>bold</b>.</p>", "One & all First text bold."),
    ("<p>List:</p><ul><li>one<li>two <a href=x>link</a></ul><ol><li>three</ol>", "List: one two link three"),
    ("<h2 id='related-work'>Related work</h2><p class='notice'>Note.</p><table><tr><td>x<td>y</table>", "Related work Note. x y"),
    ("<p>Code <pre>a  b\nc</pre><blockquote>Said so</blockquote><p>é&nbsp;&#65;", "Code a b c Said so é A"),
    ("<p>Start</p><form>mail <input></form><div class='social-share'>Tweet</div><p>End <svg/> of it</p>", "Start End of it"),
]
LAYOUTS = [
    "<html><head><title>No</title></head><body>{menu}<article>{c}</article><footer>Foot</footer></body></html>",
    "<body><header><h1>Site</h1></header>{menu}<main><article class='post'>{c}</article></main></body>",
    "<body>{menu}<div class='layout has-sidebar'><article>{c}</article><div class='sidebar'>Side</div></div></body>",
    "<body>{menu}<div id='content'>{c}</div><div class='comment-list'><p>I say</p></div></body>",
    "<div class='wrapper'><div class='post'>{c}</div><ol class='commentlist'><li>Nice</li></ol></div>",
    "<div id='comments-page'>{c}</div><section id='comments'><p>Reader</p></section>",
    "<article>{c}<section class='comments'><article class='comment'>Reader</article></section></article>{menu}",
    "<body><div class='cookie-banner'>We use</div><main>{c}</main><aside>Aside</aside></body>",
    "<table><tr><td class='sidebar'>Side</td><td>{c}</td></tr></table>",
    "<body class='no-comments'><script>var x='<p>';</script><section>{c}</section><!-- <p>gone</p> --><footer>F</footer>",
]


@pytest.fixture(scope="module")
def html_weights(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    return html_extraction.learn_weights(pages)


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("content, expected", CONTENTS)
def test_html_layouts(html_weights, layout, content, expected):
    page = layout.format(menu=MENU, c=content)
    assert html_extraction.extract(page, html_weights) == expected
    assert html_extraction.extract(page, {}) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<article><p>One</p></article><article><h2>Two</h2><p>more</p></article>", "One Two more"),
        ("<article>Text here</article><div class='commentlist'>" + "<p>a comment</p>" * 30 + "</div>", "Text here"),
        ("<title-block>Kept</title-block><style-guide>also</style-guide> <object-list>too</object-list>", "Keptalso too"),
        ("<p>so <math><mi>x</mi></math> is</p><svg/><p>here</p>", "so x is here"),
        ("", ""),
    ],
)
def test_html_cases(html_weights, page, expected):
    assert html_extraction.extract(page, html_weights) == expected


@pytest.mark.parametrize("part", ['<a "', "<div>", "<i>", "<nav>", "<script ", "<div class=ad>", "<b><p><i>", "</b>", "<li>"])
def test_html_time_is_linear(part):
    def seconds(n):
        start = time.perf_counter()
        html_extraction.extract(part * n + "</b>" * n + "x", {})
        return time.perf_counter() - start

    seconds(100)
    assert seconds(20_000) < 6


def test_html_empty_and_repeated(spark):
    schema = "page_id long, url string, html string"
    page = "<article><p>Text</p></article>"
    rows = make(spark, [(1, "u", page), (1, "u", page), (None, None, None)], schema).withColumn("text", F.lit(1)).withColumn("a.b", F.lit(1))
    got = sorted((r.page_id or 0, r.text) for r in html_extraction.main_text(rows).collect())
    assert got == [(0, ""), (1, "Text"), (1, "Text")]
    assert html_extraction.main_text(rows.limit(0)).count() == 0
