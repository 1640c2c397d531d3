"""Phrase collocation mining with weighted acyclic automata.

A phrase is two to four words that stand together within a piece of a text. Its score compares
its count a with the counts l and r of its two parts, floor(2,000,000 * a / (l + r)), at the cut
where that is least.

1. ``boundaries``: a bounded sample of windows (four words from a position on, fewer at the end
   of a piece, behind their language) gives ranges of about ``RANGE_WORDS`` windows each.
2. Map: every task collects shards of ``SHARD_WORDS`` words. A shard's windows are sorted and
   become count transducers (``transducer``), one per range that the shard touches. The windows'
   prefixes are all phrases of one to four words, so each is stored once per shard.
3. Reduce: the transducers of one range of prefixes are united and their counts added up. Every
   prefix's total is its frequency. Rare prefixes end the walk. Only a prefix of a boundary can
   lie in two ranges; those few go on with their partial counts, whatever they are, and one
   narrow aggregate adds them up.
4. Compose: the frequent phrases of a range make one transducer, the parts that candidates ask
   for in that range make another, and walking both together finds all parts' counts. A range
   with many questions is split into pieces.
5. Candidates inside a longer one of nearly their frequency go; the first ``TOP`` of each
   language are returned.

A frequent word does not make a hot task: ranges are cut between whole windows, so its phrases
spread over as many ranges as they need, and repeated windows are one entry per shard.

Defined results: a null text is empty; a null language is ``und``, one language with rows
labelled so. Pieces end at .,;:!? and at line breaks (0x0A to 0x0D), words at spaces and tabs;
only A-Z is lower-cased. Equal rows count as often as they are listed. Ties in the score go by
frequency, then by the phrase's bytes. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from sessionloom.llm.common import LOWER, UPPER, col
from sessionloom.llm.transducer import CountTransducer, summed
from sessionloom.session import Staging

LONGEST, LEAST, TOP, PERCENT, FACTOR = 4, 30, 2000, 80, 2_000_000
SHARD_WORDS = RANGE_WORDS = 1_500_000
#: At most so many ranges and sampled windows a range: bounds what the driver holds and broadcasts.
MOST_RANGES, SAMPLED = 16_384, 32
#: Bytes of a word that a boundary keeps.
BOUND_BYTES = 32
#: Questions that one piece of a range answers.
QUESTIONS = 250_000
#: Bytes of a text that are split into words at once.
CHUNK = 1 << 20

#: Upper case to lower case, tab to space, and all ends of a piece to one of them.
_TABLE = bytes.maketrans((UPPER + "\t.,;:!?\x0b\x0c\r").encode(), (LOWER + " " + "\n" * 9).encode())

Phrase = tuple[bytes, ...]


def tokens(text: str) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; a line feed stands for the end of a piece."""
    plain = text.encode("utf-8", "replace").translate(_TABLE).replace(b"\n", b" \n ")
    at = 0
    while at < len(plain):
        to = plain.find(b" ", at + CHUNK)
        to = len(plain) if to < 0 else to
        yield [t for t in plain[at:to].split(b" ") if t]
        at = to


class Shard:
    """Words of some texts as numbers, up to a flush."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {b"\n": 0}
        self.parts: list[np.ndarray] = []
        self.languages: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: bytes, words: list[bytes]) -> None:
        number = self.number
        for w in (lang, *words):
            if w not in number:
                number[w] = len(number)
        self.parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        self.languages.append(np.full(len(words), number[lang], np.int32))
        self.size += len(words)

    def last(self, count: int) -> list[bytes]:
        """The last words, for a shard that goes on in the middle of a text."""
        names = list(self.number)
        return [names[i] for i in np.concatenate(self.parts)[-count:].tolist()]

    def windows(self, until: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Sorted vocabulary, sorted distinct windows from the first ``until`` words on, and their counts."""
        words = sorted(w for w in self.number if w != b"\n")
        label = np.zeros(len(self.number), np.int32)
        label[[self.number[w] for w in words]] = np.arange(1, len(words) + 1)
        line = label[np.concatenate([*self.parts, np.zeros(LONGEST, np.int32)])]
        rows = np.zeros((until, LONGEST + 1), np.int32)
        rows[:, 0] = label[np.concatenate(self.languages)[:until]]
        inside = np.ones(until, bool)
        for k in range(LONGEST):
            inside &= line[k : k + until] > 0
            rows[inside, k + 1] = line[k : k + until][inside]
        rows = rows[line[:until] > 0]
        return words, *summed(rows, np.ones(len(rows), np.int64), len(words))


class Sample:
    """The windows with the smallest random numbers, about as many as the words seen ask for."""

    def __init__(self, range_words: int):
        self.range_words, self.seen = range_words, 0
        self.held: list[tuple[int, list[bytes]]] = []
        self.limit = 1 << 62

    def add(self, lang: bytes, words: list[bytes], rng: np.random.Generator) -> None:
        self.seen += len(words)
        spots = rng.integers(0, 1 << 62, len(words))
        for i in np.flatnonzero(spots < self.limit).tolist():
            if words[i] != b"\n":
                window = words[i : i + LONGEST]
                window = window[: window.index(b"\n")] if b"\n" in window else window
                self.held.append((int(spots[i]), [lang, *window]))
        if len(self.held) > 4 * self.most:
            self.trim()

    @property
    def most(self) -> int:
        return 64 + 2 * SAMPLED * self.seen // self.range_words

    def trim(self) -> None:
        self.held = sorted(self.held)[: self.most]
        self.limit = self.held[-1][0]


def cut_short(window: list[bytes]) -> Phrase:
    """A boundary from a window: it ends with the first word that had to be cut."""
    long = next((i for i, w in enumerate(window) if len(w) > BOUND_BYTES), len(window))
    return tuple(w[:BOUND_BYTES] for w in window[: long + 1])


def boundaries(rows: DataFrame, stage: Staging, range_words: int = RANGE_WORDS, most_ranges: int = MOST_RANGES) -> list[Phrase]:
    """Sorted prefixes of windows that cut all windows into ranges of about ``range_words``.

    Every task keeps the windows with the smallest random numbers (seeded by the text), twice
    its share of what is wanted; the smallest of all come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sample(range_words)
        for batch in batches:
            for lang, text in _texts(batch):
                rng = np.random.Generator(np.random.PCG64(xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))))
                for words in tokens(text):
                    sample.add(lang, words, rng)
        if sample.held:
            sample.trim()
        spots, windows = [s for s, _ in sample.held], [list(cut_short(w)) for _, w in sample.held]
        yield pa.RecordBatch.from_pydict({
            "spot": pa.array([*spots, None], pa.int64()), "window": pa.array([*windows, None], pa.list_(pa.binary())),
            "seen": pa.array([None] * len(spots) + [sample.seen], pa.int64())})

    drawn = stage.put("sample", rows.mapInArrow(run, "spot long, window array<binary>, seen long"))
    words = drawn.agg(F.sum("seen").alias("n")).first()["n"] or 0
    ranges = max(1, min(most_ranges, -(-words // range_words)))
    found = drawn.filter("spot is not null").select("spot", "window").orderBy("spot", "window").limit(SAMPLED * ranges).collect()
    windows = sorted(tuple(map(bytes, r["window"])) for r in found)
    return sorted({windows[len(windows) * i // ranges] for i in range(1, ranges)}) if windows else []


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, str]]:
    for lang, text in zip(batch.column(0), batch.column(1)):
        yield lang.as_py().encode("utf-8", "replace"), text.as_py()


def _pieces(words: list[bytes], rows: np.ndarray, counts: np.ndarray, bounds: list[Phrase]) -> Iterator[tuple[int, CountTransducer]]:
    """The ranges that a shard's sorted windows touch, each with its transducer."""
    at, window = 0, lambda i: tuple(words[x - 1] for x in rows[i].tolist() if x)
    while at < len(rows):
        which = bisect_right(bounds, window(at))
        to = bisect_left(range(len(rows)), bounds[which], lo=at, key=window) if which < len(bounds) else len(rows)
        used = np.zeros(len(words) + 1, bool)
        used[rows[at:to]] = True
        used[0] = False  # pads
        label = np.cumsum(used, dtype=np.int32)
        label[0] = 0
        yield which, CountTransducer.build([words[x - 1] for x in np.flatnonzero(used).tolist()], label[rows[at:to]], counts[at:to])
        at = to


def _batch(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(schema), schema.values())], names=list(schema))


_STORED = {"range": pa.int32(), "part": pa.binary()}
_COUNTED = {"lang": pa.string(), "phrase": pa.string(), "size": pa.int32(), "f": pa.int64()}


def counted(rows: DataFrame, bounds: list[Phrase], stage: Staging, least: int = LEAST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, phrase, size, f`` of all phrases of one to four words with ``f >= least``, and with size 0 the words of each language."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(bounds)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()

        def flush(until: int) -> Iterator[pa.RecordBatch]:
            for which, part in _pieces(*shard.windows(until), sent.value):
                yield _batch(_STORED, [(which, part.dump())])

        for batch in batches:
            for lang, text in _texts(batch):
                for words in tokens(text):
                    shard.add(lang, words)
                    if shard.size >= shard_words:  # the last words go on, as their windows are open
                        yield from flush(shard.size - LONGEST + 1)
                        rest, shard = shard.last(LONGEST - 1), Shard()
                        shard.add(lang, rest)
                shard.add(lang, [b"\n"])
        if shard.size:
            yield from flush(shard.size)

    def unite(key: tuple, table: pa.Table) -> pa.Table:
        which, bounds = key[0].as_py(), sent.value
        ends = bounds[max(0, which - 1) : which + 1]  # what a range shares with its neighbours begins like one of them
        shared = {b[:k] for b in ends for k in range(2, LONGEST + 1)}
        united = CountTransducer.union(table.column("part").to_pylist(), LONGEST + 1)
        rows = [(p[0].decode(), b" ".join(p[1:]).decode(), len(p) - 1, f) for p, f in united.prefixes(least, shared)]
        return pa.Table.from_batches([_batch(_COUNTED, rows)])

    parts = rows.mapInArrow(build, "range int, part binary")
    found = parts.groupBy("range").applyInArrow(unite, "lang string, phrase string, size int, f long")
    total = found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return stage.put("counted", total.filter((F.col("f") >= least) | (F.col("size") == 0)))


def _placed(rows: DataFrame, phrase: str, bounds: list[Phrase]) -> DataFrame:
    """Add the range of every phrase."""
    sent = rows.sparkSession.sparkContext.broadcast(bounds)
    lang, part = rows.columns.index("lang"), rows.columns.index(phrase)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(lang).to_pylist(), batch.column(part).to_pylist())
            which = [bisect_right(sent.value, _sequence(x, p)) for x, p in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(which, pa.int32())], names=[*batch.schema.names, "range"])

    return rows.mapInArrow(run, f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, range int")


def _sequence(lang: str, phrase: str) -> Phrase:
    return (lang.encode("utf-8", "replace"), *phrase.encode("utf-8", "replace").split(b" "))


_ANSWERED = {"lang": pa.string(), "phrase": pa.string(), "k": pa.int32(), "side": pa.string(), "f": pa.int64()}


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """The counts of all parts that candidates ask for, by composing their automaton with that of the counts."""
    parts = list(map(_sequence, asked.column("lang").to_pylist(), asked.column("part").to_pylist()))
    number = {p: i for i, p in enumerate(dict.fromkeys(parts), 1)}
    counts = CountTransducer.of(
        list(map(_sequence, known.column("lang").to_pylist(), known.column("phrase").to_pylist())), known.column("f").to_pylist(), LONGEST + 1)
    wanted = CountTransducer.of(list(number), list(number.values()), LONGEST + 1)
    _, f, which = counts.compose(wanted)
    found = np.zeros(len(number) + 1, np.int64)
    found[which] = f
    answers = found[[number[p] for p in parts]] if parts else found[:0]
    return pa.table({n: pa.array(answers, t) if n == "f" else asked.column(n).cast(t) for n, t in _ANSWERED.items()})


def part_counts(counts: DataFrame, bounds: list[Phrase], stage: Staging, questions: int = QUESTIONS) -> DataFrame:
    """``lang, phrase, k, side, f``: of every candidate and cut after ``k`` words, the counts of its left and right part."""
    words = F.split("phrase", " ", -1)
    sides = F.flatten(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit("l").alias("side"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("part")),
        F.struct(k.alias("k"), F.lit("r").alias("side"), F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("part")))))
    asked = counts.filter("size > 1").select("lang", "phrase", F.explode(sides).alias("x")).select("lang", "phrase", "x.*")
    asked = stage.put("asked", _placed(asked, "part", bounds))
    # at most one row a range, and there are at most MOST_RANGES
    pieces = F.broadcast(asked.groupBy("range").agg(F.ceil(F.count("*") / questions).cast("int").alias("pieces")))
    piece = F.pmod(F.xxhash64("lang", "phrase"), F.col("pieces")).cast("int")
    asked = asked.join(pieces, "range").withColumn("piece", piece).drop("pieces")
    known = _placed(counts.filter("size > 0").select("lang", "phrase", "f"), "phrase", bounds).join(pieces, "range")
    known = known.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    return asked.groupBy("range", "piece").cogroup(known.groupBy("range", "piece")).applyInArrow(
        _answer, "lang string, phrase string, k int, side string, f long")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def scored(counts: DataFrame, parts: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, score`` of every candidate, at its lowest-scoring cut."""
    side = lambda k, s: F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("part"))).alias(f"{s}{k}")
    wide = parts.withColumnRenamed("f", "part").groupBy("lang", "phrase").agg(*[side(k, s) for k in range(1, LONGEST) for s in "lr"])
    cut = lambda k: F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"(cast(a as decimal(20,0)) * {FACTOR}) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0)))").alias("score"),
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    candidates = counts.filter("size > 1").withColumnRenamed("f", "a")
    best = F.array_min(F.filter(F.array(*[cut(k) for k in range(1, LONGEST)]), lambda c: c.isNotNull()))
    return candidates.join(wide, ["lang", "phrase"]).withColumn("best", best).select(
        "lang", "phrase", "size", "a", "best.l", "best.r", "best.score")


def inside_longer(counts: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: the greatest count of a longer candidate that contains the phrase."""
    words = F.split("phrase", " ", -1)
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    longer = counts.filter("size > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "f")
    return longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def mine(docs: DataFrame, stage: Staging, least: int = LEAST, top: int = TOP, percent: int = PERCENT, text: str = "text", lang: str = "lang",
         range_words: int = RANGE_WORDS, shard_words: int = SHARD_WORDS, questions: int = QUESTIONS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best collocations, n its number of words."""
    rows = docs.select(F.coalesce(col(lang).cast("string"), F.lit("und")).alias("lang"), col(text).cast("string").alias("text")).filter("text is not null")
    bounds = boundaries(rows, stage, range_words)
    counts = counted(rows, bounds, stage, least, shard_words)
    found = scored(counts, part_counts(counts, bounds, stage, questions)).join(inside_longer(counts), ["lang", "phrase"], "left")
    found = found.filter(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * percent))
    # first the best of 64 parts of a language, so that no task orders a whole one
    best, order = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))), (F.desc("score"), F.desc("a"), F.col("phrase"))
    for by in (["lang", "part"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    ranked = best
    sizes = counts.filter("size = 0").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    return ranked.join(sizes, F.col("lang") == F.col("of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
