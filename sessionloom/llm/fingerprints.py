"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a set of weighted terms: its words with A-Z lower-cased, weighted by how often
they occur. Sample k draws for every term two Gamma(2, 1) variables r and c and a uniform b,
all functions of (term, k) alone. A term of weight S gets t = floor(ln S / r + b) and
ln a = ln c - r (t - b) - r; the sample is the (term, t) with the smallest a. Two documents
agree in a sample with a probability equal to their generalised Jaccard similarity, the sum
of the smaller weights over the sum of the larger ones. ``likeness`` is the share of samples
that agree; with n samples its standard deviation is at most 0.5 / sqrt(n).

``with_next`` gives every document its successor by descending doc_id without a global sort:
ids are cut into ranges (quantiles, each divided evenly) from one narrow aggregate, and the
first row of a range is copied to the range before it, so that one shuffle of the texts by
range is enough for the successor, the term weights, the samples and the comparison with the
successor's fingerprint. A range holds about ``RANGE_ROWS`` documents, or a 65,536th of them.

Only the quantiles (at most 257 numbers) come to the driver; broadcast are the ranges' first
ids (at most 65,536 rows).

Defined results: a null text is the empty text; a text without words has the fingerprint of
zeros, which equals only that of another such text. A null doc_id comes after all others;
rows of one doc_id follow each other by the hash of their text, then by the text, and the
last row's successor is the first (a single row's is itself). Repeated rows have equal
fingerprints. An empty table gives no rows. Many rows of one doc_id share a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sessionloom.llm.common import BREAK, ascii_lower, col, utf8, whole_text

SAMPLES = 32
RANGE_ROWS, QUANTILES, MOST_RANGES = 500, 256, 65_536
#: Hex digits of a sample in the fingerprint; its bits in a sample's sort key.
DIGITS, ID_BITS = 6, 22
_PART = 21


def _uniform(hashed: Column, at: int) -> Column:
    """21 bits of a hash, from bit ``at`` on, as a number between 0 and 1."""
    part = F.shiftrightunsigned(hashed, at).bitwiseAND(F.lit((1 << _PART) - 1))
    return (part.cast("double") + 0.5) * (2.0 ** -_PART)


def sample_key(term: Column, log_weight: Column, k: int) -> Column:
    """A long that sorts by a; its low bits identify (term, t). ``term`` is a 64-bit hash."""
    one, two = F.xxhash64(term, F.lit(k)), F.xxhash64(term, F.lit(-1 - k))
    r = -F.log(_uniform(one, 0) * _uniform(one, _PART))
    b = _uniform(one, 2 * _PART)
    c = -F.log(_uniform(two, 0) * _uniform(two, _PART))
    t = F.floor(log_weight / r + b)
    log_a = F.log(c) - r * (t - b) - r
    order = F.floor((log_a + 64.0) * float(1 << 32))  # ln a lies between -62 and 35
    name = F.shiftrightunsigned(two, 2 * _PART).bitwiseXOR(t * F.lit(2654435761)).bitwiseAND(F.lit((1 << ID_BITS) - 1))
    return F.shiftleft(order, ID_BITS).bitwiseOR(name)


def likeness(x: Column, y: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints; null if one is null."""
    same = [(F.substring(x, 1 + DIGITS * k, DIGITS) == F.substring(y, 1 + DIGITS * k, DIGITS)).cast("int") for k in range(samples)]
    return sum(same[1:], same[0]) / F.lit(float(samples))


def _range(docs: DataFrame) -> Column:
    """The range of a doc_id, increasing with it, -1 at null."""
    found = docs.agg(F.count("*").alias("rows"), F.percentile_approx(
        "doc_id", F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)]), F.lit(100_000)).alias("cuts")).first()
    cuts = sorted({*(found["cuts"] or [0])})
    quantiles = max(1, len(cuts) - 1)
    ranges = min(MOST_RANGES, max(1, -(-found["rows"] // RANGE_ROWS)))
    parts = -(-ranges // quantiles)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    place = F.greatest(F.lit(0), F.size(F.filter(bounds, lambda x: x <= F.col("doc_id"))) - 1)
    low = F.element_at(bounds, place + 1)
    width = F.coalesce(F.try_element_at(bounds, place + 2), low) - low
    inside = F.least(F.lit(parts - 1), F.floor((F.col("doc_id") - low) / (width + 1.0) * parts))
    at = place * parts + F.greatest(F.lit(0), inside)
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at).cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """``range, place, copy, doc_id, text, next_text``; rows with ``copy`` are their range's last and no result."""
    at = _range(docs)
    heads = docs.groupBy(at.alias("range")).agg(F.max("doc_id").alias("head"))
    rising = Window.orderBy("range")  # at most 65,537 rows
    first = F.min("range").over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.withColumn("into", F.coalesce(F.lead("range").over(rising), first)).drop("range")
    placed = docs.withColumn("at", at).join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("at").alias("range"), F.lit(False).alias("copy"))
    lent = F.struct(F.col("into").alias("range"), F.lit(True).alias("copy"))
    rows = placed.select("doc_id", "text", F.explode(F.when(F.col("into").isNull(), F.array(own)).otherwise(F.array(own, lent))).alias("to"))
    rows = rows.select("to.range", "to.copy", "doc_id", "text")
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return rows.withColumns({"place": F.row_number().over(order), "next_text": F.lead("text").over(order)})


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points, rounded down, replaced by the first as many of the next text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def _digits(samples: list[Column]) -> Column:
    """The fingerprint of the least sample keys; zeros where there is no term."""
    names = [F.coalesce(s.bitwiseAND(F.lit((1 << ID_BITS) - 1)), F.lit(0)) for s in samples]
    return F.concat(*[F.lpad(F.lower(F.hex(n)), DIGITS, "0") for n in names])


def _terms(words: Column) -> Column:
    return F.when(words != "", F.xxhash64(words))


def sampled(rows: DataFrame, key: list[str], samples: int = SAMPLES) -> DataFrame:
    """``key`` and the ``fingerprint`` of each row's ``text``. No shuffle if the rows are partitioned by part of ``key``."""
    terms = rows.select(*key, F.explode(F.split(ascii_lower(F.col("text")), BREAK)).alias("word"))
    terms = terms.select(*key, _terms(F.col("word")).alias("term"))
    weighted = terms.groupBy(*key, "term").agg(F.count("*").alias("weight"))
    weighted = weighted.select(*key, "term", F.log(F.col("weight").cast("double")).alias("log_weight"))
    term = F.col("term")
    least = [F.min(F.when(term.isNotNull(), sample_key(term, F.col("log_weight"), k))).alias(f"s{k}") for k in range(samples)]
    found = weighted.groupBy(*key).agg(*least)
    return found.select(*key, _digits([F.col(f"s{k}") for k in range(samples)]).alias("fingerprint"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, fingerprint`` of every document's text, in input order."""
    rows = docs.select(col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return sampled(rows.withColumn("row", F.monotonically_increasing_id()), ["row", "doc_id"], samples).drop("row")


#: Which of the two texts a term row counts for; 0 marks a row that holds a fact of the document.
TEXT, CHANGED, FACT = 1, 2, 0
_DIGEST = [f"d{i}" for i in range(4)]
_FACTS = ["doc_id", "n_chars", "lent", *_DIGEST]


def _words_of_both(rows: DataFrame) -> DataFrame:
    """``range, place, side, kind, term`` of the words of a text and of its edited text.

    The words before the cut are listed once for both; the word that is cut goes with what
    follows on either side. The facts of a document, all numbers, take a row each, in which
    ``kind`` (0 at words) numbers the fact and ``term`` is its value: no word row carries them.
    """
    text, half = F.col("text"), F.floor(F.char_length("text") / 2).cast("int")
    whole = F.char_length("text") - half
    following = F.coalesce("next_text", F.lit(""))
    sha = F.sha2(utf8(edited(text, following)), 256)
    rows = rows.select(
        "range", "place", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.col("copy").cast("long").alias("lent"),
        *[F.conv(F.substring(sha, 1 + 16 * i, 16), 16, -10).cast("long").alias(d) for i, d in enumerate(_DIGEST)],
        F.split(ascii_lower(F.substring(text, F.lit(1), whole)), BREAK).alias("head"),
        ascii_lower(F.substring(text, whole + 1, half)).alias("tail"),
        ascii_lower(F.substring(following, F.lit(1), half)).alias("other"),
    )
    cut = F.element_at("head", -1)
    rows = rows.select("range", "place", *_FACTS, F.slice("head", F.lit(1), F.size("head") - 1).alias("both"),
                       F.split(F.concat(cut, F.col("tail")), BREAK).alias("own"), F.split(F.concat(cut, F.col("other")), BREAK).alias("new"))
    rows = rows.withColumns({"b": F.size("both") + len(_FACTS), "o": F.size("own")})
    facts = F.array(*[F.lit("")] * len(_FACTS))
    words = rows.select("range", "place", *_FACTS, "b", "o", F.posexplode(F.concat(facts, "both", "own", "new")).alias("i", "word"))
    i = F.col("i")
    side = F.when(i < len(_FACTS), FACT).when(i < F.col("b"), TEXT + CHANGED).when(i < F.col("b") + F.col("o"), TEXT).otherwise(CHANGED)
    term = F.when(i >= len(_FACTS), _terms(F.col("word")))
    for n, c in enumerate(_FACTS):
        term = term.when(i == n, F.col(c))
    return words.select("range", "place", side.alias("side"), F.when(i < len(_FACTS), i + 1).otherwise(0).alias("kind"), term.alias("term"))


def compared(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    A term has one row with its weights in both texts; where they are equal, as most are, its
    samples are drawn once for both.
    """
    rows = with_next(docs.select(col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")))
    words = _words_of_both(rows)
    weight = lambda side: F.count_if(F.col("side").bitwiseAND(F.lit(side)) > 0)
    terms = words.groupBy("range", "place", "kind", "term").agg(weight(TEXT).alias("w"), weight(CHANGED).alias("v"))
    sides = (
        F.when(F.col("w") == F.col("v"), F.array(F.lit(TEXT + CHANGED))).when(F.col("v") == 0, F.array(F.lit(TEXT)))
        .when(F.col("w") == 0, F.array(F.lit(CHANGED))).otherwise(F.array(F.lit(TEXT), F.lit(CHANGED)))
    )
    terms = terms.select("range", "place", "kind", "term", "w", "v", F.explode(sides).alias("side"))
    count = F.when(F.col("side") == CHANGED, F.col("v")).otherwise(F.col("w"))
    terms = terms.withColumn("log_weight", F.log(F.greatest(count, F.lit(1)).cast("double")))
    real = (F.col("kind") == 0) & F.col("term").isNotNull()
    drawn = terms.groupBy("range", "place", "side").agg(
        *[F.max(F.when(F.col("kind") == n, F.col("term"))).alias(c) for n, c in enumerate(_FACTS, 1)],
        *[F.min(F.when(real, sample_key(F.col("term"), F.col("log_weight"), k))).alias(f"s{k}") for k in range(samples)])
    of = lambda side, k: F.min(F.when(F.col("side").bitwiseAND(F.lit(side)) > 0, F.col(f"s{k}")))
    found = drawn.groupBy("range", "place").agg(
        *[F.max(c).alias(c) for c in _FACTS],
        *[of(side, k).alias(f"{name}{k}") for k in range(samples) for name, side in (("s", TEXT), ("e", CHANGED))])
    sha = F.concat(*[F.lpad(F.lower(F.hex(d)), 16, "0") for d in _DIGEST])
    found = found.select(
        "range", "place", "doc_id", "n_chars", "lent", sha.alias("edited_sha256"),
        _digits([F.col(f"s{k}") for k in range(samples)]).alias("fingerprint"),
        _digits([F.col(f"e{k}") for k in range(samples)]).alias("edited_fingerprint"))
    following = F.lead("fingerprint").over(Window.partitionBy("range").orderBy("place"))
    return found.withColumn("next_fingerprint", following).filter("lent = 0").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
