"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle is hashed once; the high bits of the hash name a bin, the smallest
hash of a bin stands for it. An empty bin takes the value of a bin that is not
empty (optimal densification): each bin has its own fixed sequence of random
bins, and the first of them that holds something is copied. After PROBES
failures the bins that hold something are all ranked by a hash of the pair, which
is the same draw to its end. A fingerprint keeps the low BITS of each bin, packed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paddock.llm.common import pick
from paddock.operators.borders import borders, default_parts, with_part

#: Words of a shingle.
SHINGLE = 5
#: The standard error of a likeness is about 1 / (2 * sqrt(BINS)) at most.
BINS = 256
#: Bits kept of each bin: two different bins agree in one case of 2 ** BITS.
BITS = 4
#: Bins drawn for an empty bin before all are ranked.
PROBES = 8
#: Parts of the table for each shuffle partition where the next document is looked up, and sampled keys for each;
#: many parts make partitions even, whichever parts meet in one.
PARTS, SAMPLED = 16, 8

_BIN_SHIFT = 56  # a bin is the highest byte of a hash
_REST = (1 << _BIN_SHIFT) - 1
_LOW = (1 << BITS) - 1
_PER_WORD = 64 // BITS
_LOWEST_OF_EACH = 0x1111111111111111
_SPACES = r"[\x20\x09-\x0D]+"
_SPACE = " \t\n\x0b\x0c\r"


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with the fingerprint of a text column, an array of BINS * BITS / 64 longs.

    A text of fewer than SHINGLE words is one shingle; one without words (or
    null) has a fingerprint of zeros.
    """
    step = lambda what: f"_{name}_{what}"
    col = lambda what: F.col(step(what))
    plain = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    words = F.when(plain != "", F.split(plain, _SPACES)).otherwise(F.array().cast("array<string>"))
    out = df.withColumn(step("words"), F.transform(words, lambda word: F.xxhash64(word)))
    out = out.withColumn(step("n"), F.size(step("words")))
    at = lambda i: F.get(col("words"), i)
    long_text = F.transform(
        F.sequence(F.lit(0), F.greatest(col("n") - SHINGLE, F.lit(0))),
        lambda i: F.xxhash64(*[at(i + k) for k in range(SHINGLE)]),
    )
    shingles = (
        F.when(col("n") >= SHINGLE, long_text)
        .when(col("n") > 0, F.array(F.xxhash64(step("words"))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    # the largest hash of each bin stands for nothing, so that every bin is there once the hashes are sorted
    half = BINS // 2
    nothing = F.transform(
        F.sequence(F.lit(-half), F.lit(half - 1)), lambda b: F.shiftleft(b.cast("long"), _BIN_SHIFT) + F.lit(_REST)
    )
    out = out.withColumn(step("sorted"), F.sort_array(F.concat(shingles, nothing)))
    bin_of = lambda value: F.shiftright(value, _BIN_SHIFT)
    starts = lambda value, i: (i == 0) | (bin_of(value) != bin_of(F.get(col("sorted"), i - 1)))
    smallest = F.filter(col("sorted"), starts)
    kept = lambda value: F.when(value.bitwiseAND(F.lit(_REST)) != _REST, value.bitwiseAND(F.lit(_LOW)).cast("int"))
    out = out.withColumn(step("bins"), F.transform(smallest, kept))
    # bin and value in one number
    pair = lambda value, i: F.when(value.isNotNull(), F.shiftleft(i, BITS).bitwiseOR(value))
    out = out.withColumn(step("full"), F.filter(F.transform(col("bins"), pair), lambda value: value.isNotNull()))

    def ranked(i: Column) -> Column:
        draw = lambda p: F.xxhash64(i, F.shiftright(p, BITS)).bitwiseAND(F.lit(~_LOW)).bitwiseOR(p.bitwiseAND(F.lit(_LOW)))
        return F.array_min(F.transform(col("full"), draw)).bitwiseAND(F.lit(_LOW)).cast("int")

    def filled(value: Column, i: Column) -> Column:
        drawn = [F.get(col("bins"), _draw(i, t)) for t in range(PROBES)]
        return F.coalesce(value, *drawn, ranked(i))

    # columns that are read inside a function of array elements are read beside it too: the optimizer moves an
    # expression that is read once to where it is read, and would evaluate it for every element
    some = F.size(step("full")) > 0
    out = out.withColumn(step("filled"), F.when(some, F.transform(col("bins"), filled)))
    packed = F.transform(
        F.sequence(F.lit(0), F.lit(BINS // _PER_WORD - 1)),
        lambda g: F.aggregate(
            F.slice(step("filled"), g * _PER_WORD + 1, _PER_WORD),
            F.lit(0).cast("long"),
            lambda word, value: F.shiftleft(word, BITS).bitwiseOR(value.cast("long")),
        ),
    )
    nothing_kept = F.array_repeat(F.lit(0).cast("long"), BINS // _PER_WORD)
    out = out.withColumn(name, F.when(F.col(step("filled")).isNotNull(), packed).otherwise(nothing_kept))
    return out.drop(*[step(w) for w in ("words", "n", "sorted", "bins", "full", "filled")])


def _draw(i: Column, t: int) -> Column:
    """The bin that bin i tries at its t-th draw."""
    return F.xxhash64(i, F.lit(t)).bitwiseAND(F.lit(BINS - 1)).cast("int")


def likeness(one: str, other: str) -> Column:
    """Estimated Jaccard similarity of the shingles behind two fingerprints, 0 to 1.

    Bins of different texts agree in their low bits by chance in one case of
    2 ** BITS; that share is taken out.
    """
    differing = F.zip_with(one, other, lambda a, b: a.bitwiseXOR(b))
    either = F.transform(differing, lambda z: z.bitwiseOR(F.shiftrightunsigned(z, 1)))
    any_bit = lambda z: z.bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseAND(F.lit(_LOWEST_OF_EACH))
    unlike = F.aggregate(either, F.lit(0), lambda n, z: n + F.bit_count(any_bit(z)))
    chance = 1.0 / (1 << BITS)
    return F.greatest(F.lit(0.0), (1.0 - unlike / BINS - chance) / (1.0 - chance))


def digits(fingerprint: str) -> Column:
    """A fingerprint as lowercase hex digits, one for each bin."""
    return F.array_join(F.transform(fingerprint, lambda word: F.lower(F.lpad(F.hex(word), 16, "0"))), "")


def with_next(docs: DataFrame, key: str, parts: int, **values: str) -> DataFrame:
    """The rows with values of the next row by descending key; the first row follows the last one.

    Rows are cut at borders taken from the keys. The row at a border is given to
    both of its parts: the upper one sees it as a next row, the lower one keeps
    it; the rows of the largest key are also put behind the last part. So each
    part is on its own, rows are shuffled once, and no part is larger than its
    share of the keys. Rows of one key are ordered by their text.
    """
    cut = with_part(docs, key, borders(docs, key, parts, sampled=SAMPLED), parts, "_part", "_edge")
    largest = cut.withColumn("_first", F.col(key) == docs.agg(F.max(key)).scalar())
    place = lambda part, keeps, behind: F.struct(part.alias("part"), F.lit(keeps).alias("keeps"), F.lit(behind).alias("behind"))
    here, none = F.col("_part"), F.array().cast("array<struct<part: int, keeps: boolean, behind: int>>")
    places = F.concat(
        F.when(F.col("_edge"), F.array(place(here, False, 0), place(here - 1, True, 0))).otherwise(
            F.array(place(here, True, 0))
        ),
        F.when(F.col("_first"), F.array(place(F.lit(0), False, 1))).otherwise(none),
    )
    dealt = largest.withColumn("_place", F.explode(places))
    order = W.partitionBy("_place.part").orderBy("_place.behind", F.desc(key), "text")
    following = dealt.withColumns({name: F.lead(value).over(order) for name, value in values.items()})
    return following.where("_place.keeps").select(*docs.columns, *values)


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text has its last floor(n_chars / 3) code points replaced by the
    first as many (or all) of the next document by descending doc_id, the first
    one after the last. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (likeness to the edited text and
    to the next document). A null text counts as empty: no characters, a
    fingerprint of zeros; two texts without words are alike (1). Rows without a
    doc_id come last. Rows of one doc_id follow each other by their text;
    repeated rows stay. An empty table gives an empty result; other columns are
    not looked at.
    """
    plain = pick(docs, "doc_id", "text").withColumns(
        {"text": F.coalesce("text", F.lit("")), "key": F.coalesce("doc_id", F.lit(-(1 << 63)))}
    )
    keyed = with_fingerprint(plain, "text", "own")
    count = PARTS * default_parts(docs) if parts is None else parts
    both = with_next(keyed, "key", count, next_text="text", next="own")
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.left("text", n - cut), F.left("next_text", cut))
    return with_fingerprint(both.withColumn("edited", edited), "edited", "other").select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digits("own").alias("fingerprint"),
        digits("other").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"),
        likeness("own", "next").alias("near_next"),
    )
