"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, one per language. Counts of the ``ORDER``-grams of all
trusted texts are aggregated, lower orders count in how many different contexts a gram
is continued, and every order has its three discounts from its own counts of counts.
Contexts, discounts and the next lower order meet in joins keyed by language and gram,
so nothing about the corpus is ever in one place and the tables grow with it.

Scoring needs the model at every character. It goes to the workers in shards of at most
``SHARD`` entries. A character belongs to the shard of the two characters before it,
which holds all grams and contexts that it can ask for, so the shards' partial sums add
up to the log-probability of a text. A document is kept if its perplexity is at most
what the ``KEEP`` quantile of its language's trusted documents allows. Of these, one in
``HELD_OUT`` sets the limit and the others are counted.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise
from .common import arrow_map
from .hashing import SEEDS, mix, refine

ORDER = 5
KEEP = 0.99
# Log-perplexity a document may have beyond the quantile.
SLACK = 0.1
# One in so many trusted documents is held out of the counts: texts that the model has
# seen are too likely to set a limit for others.
HELD_OUT = 5
SHARD = 4_000_000
# Trusted documents a language needs for a model of its own.
MIN_TRUSTED = 20
ANY = "*"
# Characters worked on at once.
CHUNK = 1 << 20
# Trusted ids that are sent to all workers (32 MB); more are met in a merge join.
BROADCAST_IDS = 4_000_000
START, STOP = "\x02", "\x03"
# Bins per unit of log-perplexity.
FINE = 1024


def normalise(text: str | None) -> str:
    """White space as single blanks, no control marks of our own."""
    text = (text or "").replace(START, " ").replace(STOP, " ")
    return " ".join(text.split())


def _codes(text: str) -> np.ndarray:
    """Code points with a start before the text and a stop behind; digits are alike."""
    padded = START * (ORDER - 1) + text + STOP
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)


def _pieces(texts: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Texts as code points in lists of about ``CHUNK``; long ones in parts that repeat
    the ``ORDER - 1`` characters before them."""
    held, size = [], 0
    for number, text in texts:
        codes = _codes(text)
        for at in range(0, len(codes) - ORDER + 1, CHUNK):
            part = codes[at : at + CHUNK + ORDER - 1]
            held.append((number, part))
            size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _letters(codes: np.ndarray) -> np.ndarray:
    return mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(SEEDS[0]))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang in sorted(set(langs)):
            own = ((i, t) for i, t in ((i, normalise(batch.column(1)[i].as_py())) for i, x in enumerate(langs) if x == lang) if t)
            for held in _pieces(own):
                codes = np.concatenate([p for _, p in held])
                ends = np.cumsum([len(p) for _, p in held])
                hashes = refine(_letters(codes), 1, ORDER)
                inside = np.ones(len(hashes), dtype=bool)
                for back in range(1, ORDER):
                    inside[ends[:-1] - back] = False
                places = np.flatnonzero(inside)
                _, first, counts = np.unique(hashes[places], return_index=True, return_counts=True)
                grams = [
                    codes[i : i + ORDER].tobytes().decode("utf-32-le", "surrogatepass") for i in places[first].tolist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())],
                    names=["lang", "gram", "n"],
                )


def gram_counts(trusted: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all texts of ``(lang, text)``."""
    counted = arrow_map(trusted, _count_batches, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(grams: DataFrame) -> DataFrame:
    """Per language the discounts of grams seen once, twice and more often."""
    seen = [F.sum((F.col("n") == i).cast("double")) for i in (1, 2, 3, 4)]
    counts = grams.groupBy("lang").agg(F.array(*seen).alias("t"))
    t = [F.col("t")[i] for i in range(4)]
    y = F.try_divide(t[0], t[0] + 2 * t[1])

    def discount(i: int) -> Column:
        plain = (i + 1) - (i + 2) * y * F.try_divide(t[i + 1], t[i])
        # Too few counts to tell: the middle of what is possible.
        possible = (plain >= 0) & (plain <= i + 1)
        return F.when(possible, plain).otherwise((i + 1) / 2)

    return counts.select("lang", F.array(*[discount(i) for i in range(3)]).alias("d"))


def train(counts: DataFrame) -> DataFrame:
    """``(lang, kind, gram, value)``: for kind ``p`` the log-probability of the last
    character of a gram after the others, for kind ``g`` the log of the weight that a
    context leaves to the next lower order. For the empty context that is what an
    unknown character gets."""
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        inner = levels[n + 1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
        levels[n] = materialise(inner.agg(F.count("*").alias("n")), f"grams-{n}")
    letters = levels[1].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("lower"))
    lower, out = None, []
    for n in range(1, ORDER + 1):
        grams = levels[n].withColumn("context", F.expr(f"substring(gram, 1, {n - 1})"))
        few = F.least("n", F.lit(3)).cast("int")
        grams = grams.join(materialise(_discounts(grams), "discounts"), "lang")
        taken = F.get("d", few - 1)
        contexts = grams.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.sum(taken) / F.sum("n")).alias("left")
        )
        contexts = materialise(contexts, f"contexts-{n}")
        own = grams.withColumn("taken", taken).join(contexts, ["lang", "context"])
        if n == 1:
            own = own.join(letters, "lang")
            left = contexts.join(letters, "lang").withColumn("left", F.col("left") * F.col("lower"))
        else:
            own = own.withColumn("rest", F.expr("substring(gram, 2)")).join(lower, ["lang", "rest"])
            left = contexts
        p = (F.col("n") - F.col("taken")) / F.col("total") + F.col("left") * F.col("lower")
        level = materialise(own.select("lang", "gram", p.alias("p")), f"model-{n}")
        lower = level.select("lang", F.col("gram").alias("rest"), F.col("p").alias("lower"))
        out.append(level.select("lang", F.lit("p").alias("kind"), "gram", F.log("p").alias("value")))
        out.append(
            left.select("lang", F.lit("g").alias("kind"), F.col("context").alias("gram"), F.log("left").alias("value"))
        )
    return reduce(DataFrame.unionByName, out)


def _seed(lang: str, kind: str, n: int) -> int:
    return xxhash.xxh64_intdigest(f"{kind}{n} {lang}".encode(), 11)


def _pair(codes: np.ndarray) -> np.ndarray:
    """What the shard of a character goes by: the hash of two neighbours."""
    return mix(refine(_letters(codes), 1, 2) ^ np.uint64(SEEDS[1]))


def _key_batches(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # Grams of one language, kind and length are hashed together, end to end.
        alike = defaultdict(list)
        grams = batch.column(2).to_pylist()
        for i, (lang, kind, gram) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), grams)):
            alike[lang, kind, len(gram)].append(i)
        keys = np.empty(len(grams), dtype=np.uint64)
        # Short contexts are asked for everywhere.
        owners = np.full(len(grams), -1, dtype=np.int32)
        for (lang, kind, n), places in alike.items():
            codes = np.frombuffer("".join(grams[i] for i in places).encode("utf-32-le", "surrogatepass"), np.uint32)
            hashed = refine(_letters(codes), 1, n)[::n] if n else np.zeros(len(places), np.uint64)
            keys[places] = mix(hashed ^ np.uint64(_seed(lang, kind, n))) | np.uint64(1)
            context = n - 1 if kind == "p" else n
            if context > 1:
                owners[places] = _pair(codes)[context - 2 :: n] % np.uint64(shards)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(owners), batch.column(3).cast(pa.float32())],
            names=["key", "shard", "value"],
        )


class Table:
    """Values by 64-bit key in an open hash table of arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, dtype=np.uint64)
        self.values = np.zeros(size, dtype=np.float32)
        slots = (keys >> np.uint64(7)) & self.mask
        left = np.arange(len(keys))
        while len(left):
            at = slots[left]
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]
            placed = self.keys[at] == keys[left]
            self.values[at[placed]] = values[left[placed]]
            left = left[~placed]
            slots[left] = (slots[left] + np.uint64(1)) & self.mask

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys there are, and their values (zero for the others)."""
        slots = (keys >> np.uint64(7)) & self.mask
        held = self.keys[slots]
        found = held == keys
        values = np.where(found, self.values[slots], np.float32(0))
        left = np.flatnonzero(~found & (held != 0))
        while len(left):
            slots[left] = (slots[left] + np.uint64(1)) & self.mask
            held = self.keys[slots[left]]
            hit = held == keys[left]
            values[left[hit]] = self.values[slots[left[hit]]]
            found[left[hit]] = True
            left = left[~hit & (held != 0)]
        return found, values


def _score(codes: np.ndarray, inside: np.ndarray, langs: np.ndarray, names: list[str], table: Table) -> np.ndarray:
    """Log-probability of the characters at ``inside``; ``langs`` numbers their model."""
    letters = _letters(codes)
    hashes = {n: refine(letters, 1, n) for n in range(1, ORDER + 1)}
    seeds = {
        (kind, n): np.array([_seed(name, kind, n) for name in names], dtype=np.uint64)
        for kind in "pg"
        for n in range(ORDER + 1)
    }
    total = np.zeros(len(inside))
    left = np.arange(len(inside))
    for n in range(ORDER, 0, -1):
        start = inside[left] - n + 1
        model = langs[left]
        keys = mix(hashes[n][start] ^ seeds["p", n][model]) | np.uint64(1)
        found, values = table.find(keys)
        total[left] += values
        left, start, model = left[~found], start[~found], model[~found]
        if not len(left):
            break
        context = hashes[n - 1][start] if n > 1 else np.zeros(len(left), np.uint64)
        total[left] += table.find(mix(context ^ seeds["g", n - 1][model]) | np.uint64(1))[1]
    return total


def _score_batches(
    batches: Iterator[pa.RecordBatch], keys: np.ndarray, values: np.ndarray, known: list[str], shard: int, shards: int
) -> Iterator[pa.RecordBatch]:
    table = Table(keys, values)
    numbers = {name: i for i, name in enumerate(known)}
    for batch in batches:
        models = np.array([numbers.get(x, numbers.get(ANY, 0)) for x in batch.column(1).to_pylist()], dtype=np.int64)
        sums = np.zeros(batch.num_rows)
        sizes = np.zeros(batch.num_rows, dtype=np.int64)
        texts = ((i, normalise(t.as_py())) for i, t in enumerate(batch.column(3)))
        for held in _pieces((i, t) for i, t in texts if t):
            codes = np.concatenate([p for _, p in held])
            lengths = np.array([len(p) for _, p in held])
            owner = np.repeat([i for i, _ in held], lengths)
            within = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            inside = np.flatnonzero(within >= ORDER - 1)
            if shards > 1:
                inside = inside[_pair(codes)[inside - 2] % np.uint64(shards) == shard]
            found = _score(codes, inside, models[owner[inside]], known, table)
            sums += np.bincount(owner[inside], found, batch.num_rows)
            sizes += np.bincount(owner[inside], minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(sums), pa.array(sizes)],
            names=["doc_id", "lang", "text_key", "logp", "n_scored"],
        )


def score(rows: DataFrame, model: DataFrame, known: list[str], shard_rows: int = SHARD) -> DataFrame:
    """``(doc_id, lang, text_key, logp, n_scored)`` per row of ``(doc_id, lang, text_key,
    text)``, added up over as many shards as the model needs."""
    size = model.count()
    shards = max(1, -(-size // shard_rows))
    keyed = arrow_map(model, partial(_key_batches, shards=shards), "key long, shard int, value float")
    keyed = materialise(keyed, "model")
    parts = []
    for shard in range(shards):
        part = keyed.filter(F.col("shard").isin(shard, -1)).select("key", "value").toArrow()
        keys = part.column(0).to_numpy().view(np.uint64)
        scorer = partial(
            _score_batches, keys=keys, values=part.column(1).to_numpy(), known=known, shard=shard, shards=shards
        )
        parts.append(
            arrow_map(rows, scorer, "doc_id long, lang string, text_key long, logp double, n_scored long")
        )
    if shards == 1:
        return parts[0]
    added = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "lang", "text_key").agg(
        F.sum("logp").alias("logp"), F.sum("n_scored").alias("n_scored"), F.count("*").alias("rows")
    )
    # Repeated rows were added up together; each gets its share.
    repeats = (F.col("rows") / shards).cast("int")
    return added.select(
        "doc_id", "lang", "text_key",
        (F.col("logp") / repeats).alias("logp"),
        (F.col("n_scored") / repeats).cast("long").alias("n_scored"),
        F.explode(F.array_repeat(F.lit(1), repeats)).alias("one"),
    ).drop("one")


def _thresholds(scored: DataFrame, keep: float) -> DataFrame:
    """Per model the ``keep`` quantile of log-perplexity, to a bin above."""
    binned = scored.groupBy("model", F.ceil(F.col("log_perplexity") * FINE).alias("bin")).agg(F.count("*").alias("n"))
    window = Window.partitionBy("model")
    placed = binned.withColumns(
        {"below": F.sum("n").over(window.orderBy("bin")), "total": F.sum("n").over(window)}
    )
    return placed.filter(F.col("below") >= F.lit(keep) * F.col("total")).groupBy("model").agg(
        (F.min("bin") / FINE).alias("threshold")
    )


def classify(
    docs: DataFrame,
    trusted_ids: DataFrame,
    keep: float = KEEP,
    slack: float = SLACK,
    shard_rows: int = SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(doc_id, lang, n_scored, log_perplexity, threshold, kept)`` per row of ``docs``.

    ``trusted_ids`` names the documents (first column) that the model is trained on.
    Languages with fewer than ``MIN_TRUSTED`` of them, and a null language (an empty
    string here), use the model of all trusted text. A text without characters other
    than white space has neither perplexity nor place: its values are null and it is not
    kept. Without any trusted document nothing can be judged and nothing is kept.
    Repeated rows are judged each; rows without an id are judged but never trusted."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.xxhash64(text_col).alias("text_key"),
        F.col(text_col).alias("text"),
    )
    trusted_ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("doc_id")).distinct()
    trusted_ids = materialise(trusted_ids, "trusted")
    if trusted_ids.count() <= BROADCAST_IDS:
        trusted_ids = F.broadcast(trusted_ids)
    held_out = trusted_ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)
    counted = trusted_ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) != 0)
    trusted = rows.join(counted, "doc_id", "left_semi").select("lang", "text")
    sizes = rows.select("doc_id", "lang").join(trusted_ids, "doc_id", "left_semi").groupBy("lang").count()
    known = sorted(r["lang"] for r in sizes.filter(F.col("count") >= MIN_TRUSTED).collect())
    counts = materialise(gram_counts(trusted), f"grams-{ORDER}")
    own = counts.filter(F.col("lang").isin(known))
    if not rows.filter(~F.col("lang").isin(known)).isEmpty():
        every = counts.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit(ANY).alias("lang"), "gram", "n")
        own = own.unionByName(every)
        known = sorted([*known, ANY])
    found = materialise(score(rows, train(materialise(own, f"counts-{ORDER}")), known, shard_rows), "scored")
    model = F.when(F.col("lang").isin(known), F.col("lang")).otherwise(F.lit(ANY))
    scored = found.withColumns(
        {"model": model, "log_perplexity": F.when(F.col("n_scored") > 0, -F.col("logp") / F.col("n_scored"))}
    )
    able = scored.filter("log_perplexity is not null")
    limits, seen = (
        _thresholds(able.join(ids, "doc_id", "left_semi"), keep) for ids in (held_out, trusted_ids)
    )
    # A model without any document held out goes by those it has seen.
    limits = seen.withColumnRenamed("threshold", "seen").join(limits, "model", "left").select(
        "model", F.coalesce("threshold", "seen").alias("threshold")
    )
    judged = scored.join(materialise(limits, "thresholds"), "model", "left").withColumn(
        "threshold", F.col("threshold") + slack
    )
    return judged.select(
        "doc_id", "lang", "n_scored", "log_perplexity", "threshold",
        F.coalesce(F.col("log_perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"),
    )
