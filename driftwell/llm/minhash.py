"""Document fingerprints: one-permutation MinHash with optimal densification, built-in functions only.

Every five-word shingle is hashed once; the upper bits choose one of ``BINS`` bins and the least
hash of a bin is kept.  To find it, the hashes are sorted together with one sentinel per bin, the
largest value the bin can hold: the first value of each bin is its least hash, or the sentinel if
the bin is empty.  An empty bin takes the value of another one: it asks the bins in an order of its
own, the same for all documents, until it meets a filled one.  Of each value the low ``BITS`` bits
are stored, two hexadecimal digits per bin.  Likeness is the share of bins that agree, corrected
for those that agree by chance.

Defined cases: a null text counts as empty; a text without words has an empty fingerprint, which is
like another empty one (1) and unlike all others (0).  Texts shorter than a shingle are one shingle.
A null id comes before all others; rows that share an id follow by text.  Repeated rows keep their
repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from driftwell.llm.common import id_and_text

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
_KEPT = 64 - BIN_BITS
# Sections of the id order for each shuffle partition: their sizes even out.
SECTIONS = 8
_BLANKS = " \t\n\x0b\f\r"
# Documents with fewer filled bins than this look a donor up from the filled bins' side.
_FEW = 32
_FIRST = 5


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _probe_orders() -> tuple[Column, Column, Column]:
    """Per bin the odd factor, the factor's inverse and the offset of its order of asking.

    Bin ``i`` asks ``(factor * t + offset) mod BINS`` at step ``t``; derived from ``i`` by
    multiplicative hashing, so that all documents agree.
    """
    factors, inverses, offsets = [], [], []
    for i in range(BINS):
        mixed = (i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
        mixed = (mixed ^ (mixed >> 31)) * 0xBF58476D1CE4E5B9 % (1 << 64)
        factor = (mixed >> 40) % BINS | 1
        factors.append(factor)
        inverses.append(pow(factor, -1, BINS))
        offsets.append((mixed >> 20) % BINS)
    return tuple(F.array(*[F.lit(v) for v in values]) for values in (factors, inverses, offsets))


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """One hash for each shingle, repeats included."""
    words = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS)), r"\s+")

    def of_words(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - size, F.lit(0)))
        # Places behind the end of a short text are null and leave the hash as it is.
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def _with_bins(frame: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: an array of ``BINS`` values of ``BITS`` bits, or null for a text without words."""
    factors, inverses, offsets = _probe_orders()
    low = (1 << _KEPT) - 1
    sentinels = F.transform(
        F.sequence(F.lit(-BINS // 2).cast("long"), F.lit(BINS // 2 - 1).cast("long")),
        lambda j: F.shiftleft(j, _KEPT).bitwiseOR(F.lit(low)),
    )
    wordless = F.length(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(_BLANKS))) == 0
    # Step by step, each in a column that is used more than once and so is computed once.
    sorted_ = frame.withColumn("_all", F.sort_array(F.concat(shingle_hashes(F.col(text)), sentinels)))
    least = sorted_.withColumn(
        "_least",
        F.filter("_all", lambda x, i: (i == 0) | (F.shiftright(x, _KEPT) != F.shiftright(F.get("_all", i - 1), _KEPT))),
    ).drop("_all")
    values = least.withColumn(
        "_bins",
        F.transform("_least", lambda x: F.when(x.bitwiseAND(F.lit(low)) != low, x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))),
    ).drop("_least")

    def filled() -> Column:
        """Filled bins as one number each, place and value."""
        numbers = F.transform("_bins", lambda v, i: v + F.shiftleft(i, BITS))
        return F.filter(numbers, lambda v: v.isNotNull())

    def asked(i: Column, t: Column | int) -> Column:
        return F.get("_bins", (F.get(factors, i) * t + F.get(offsets, i)).bitwiseAND(F.lit(BINS - 1)))

    def walk(i: Column, steps: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(_FIRST), steps), F.lit(None).cast("int"), lambda found, t: F.coalesce(found, asked(i, t)))

    def nearest(i: Column, numbers: Column) -> Column:
        """The filled bin that is asked first, from the step at which each of them is asked."""
        steps = F.transform(
            numbers,
            lambda v: F.shiftleft(
                (F.get(inverses, i) * (F.shiftright(v, BITS) - F.get(offsets, i))).bitwiseAND(F.lit(BINS - 1)), BITS
            ).bitwiseOR(v.bitwiseAND(F.lit((1 << BITS) - 1))),
        )
        return F.array_min(steps).bitwiseAND(F.lit((1 << BITS) - 1))

    # The first steps fill most bins, a walk nearly all the others, and the rest looks at all.
    counted = values.withColumn("_count", F.size(F.filter("_bins", lambda v: v.isNotNull())))
    reach = F.least(F.lit(BINS), F.ceil(F.lit(8 * BINS) / F.col("_count")).cast("int"))
    dense = F.transform(
        "_bins",
        lambda v, i: F.coalesce(v, *[asked(i, t) for t in range(_FIRST)], walk(i, reach), nearest(i, filled())).cast("smallint"),
    )
    sparse = _let(filled(), lambda numbers: F.transform("_bins", lambda v, i: F.coalesce(v, nearest(i, numbers)).cast("smallint")))
    chosen = F.when(wordless, F.lit(None)).when(F.col("_count") < _FEW, sparse).otherwise(dense)
    return counted.withColumn(out, chosen).drop("_bins", "_count")


def _digits(bins: Column) -> Column:
    digits = F.array(*[F.lit(f"{d:0{BITS // 4}x}") for d in range(1 << BITS)])
    shown = F.transform(bins, lambda v: F.get(digits, v))
    return F.coalesce(F.array_join(shown, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two arrays of stored values, corrected for chance agreement."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x) / BINS
    chance = 1.0 / (1 << BITS)
    corrected = F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(corrected)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, packed`` of every row; ``packed`` holds the same bits as bytes."""
    rows = _with_bins(id_and_text(docs, id_col, text_col), "text", "bins")
    return rows.select("doc_id", _digits(F.col("bins")).alias("fingerprint")).withColumn("packed", F.unhex("fingerprint"))


def _sections(rows: DataFrame) -> list[int]:
    """First ids of the sections in ascending order; taken from the data, so none is empty."""
    count = SECTIONS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / count for i in range(1, count)]
    found = rows.agg(F.min("key").alias("least"), F.percentile_approx("key", shares, max(10_000, 10 * count)).alias("cuts")).first()
    if found["least"] is None:
        return []
    return sorted({found["least"], *found["cuts"]})


def edited_neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside a copy of it that ends like the next document by id.

    ``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``.  The
    edited text has the last half of the code points replaced by as many first ones of the next
    document; the first follows the last.

    The id order is cut into sections at ids taken from the data.  The rows that begin a section
    are also sent to the end of the one before, so each row meets its next one inside a section and
    the order is never gathered in one task.
    """
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    starts = _sections(rows)
    cuts = F.array(*[F.lit(s).cast("long") for s in starts or [0]])
    last = max(len(starts) - 1, 0)
    # The last start that is not above the key, by halving steps.
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(last.bit_length()))]) if last else F.array().cast("array<int>")
    own = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when((at + step <= last) & (F.get(cuts, at + step) <= F.col("key")), at + step).otherwise(at),
    )
    first_of_own = F.get(cuts, F.col("_own")) == F.col("key")

    def place(section: Column, guest: int, after: int) -> Column:
        return F.struct(section.alias("section"), F.lit(bool(guest)).alias("guest"), F.lit(after).alias("after"))

    places = F.array_compact(
        F.array(
            place(F.col("_own"), 0, 0),
            F.when(first_of_own & (F.col("_own") > 0), place(F.col("_own") - 1, 1, 0)),
            F.when(first_of_own & (F.col("_own") == 0), place(F.lit(last), 1, 1)),
        )
    )
    described = _with_bins(rows, "text", "bins").withColumn("_own", own)
    placed = described.select("doc_id", "key", "text", "bins", F.explode(places).alias("at")).select(
        "doc_id", "key", "text", "bins", "at.section", "at.guest", "at.after"
    )
    order = Window.partitionBy("section").orderBy("after", "key", "text", "guest")
    beside = placed.withColumns(
        {"next_text": F.lead("text").over(order), "next_bins": F.lead("bins").over(order)}
    ).where(~F.col("guest"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    changed = beside.select(
        "doc_id", n.cast("long").alias("n_chars"), "bins", "next_bins", edited.alias("edited")
    )
    compared = _with_bins(changed, "edited", "edited_bins")
    return compared.select(
        "doc_id",
        "n_chars",
        "edited",
        _digits(F.col("bins")).alias("fingerprint"),
        _digits(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
