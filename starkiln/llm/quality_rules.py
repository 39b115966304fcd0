"""Quality rules by distribution divergence, in DataFrame functions only.

A document is compared with its language: the histogram of its character classes and the
histogram of the language's most common words (one more bin for all other words) against a
reference of the same shape, by Jensen-Shannon distance (square root of the divergence in
bits, 0 to 1).  Two passes read the texts:

1. words of a language are counted (partial counts per task), the most common ones kept;
2. each document becomes one narrow row: the base counts and the two histograms.  This pass
   has no shuffle; the rows are written once and everything else reads them.

A reference must not lean towards one text that a third of all rows repeat: rows are put in
``BUCKETS`` buckets by a hash of the text, so copies share a bucket, and the reference is the
mean of the buckets' shares.  References are one row per language; Spark broadcasts them
while their files are below its threshold and shuffles beyond it.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stored

#: White space between words, as in the contract of the query.
SPACE = r"[\x20\x09-\x0D]"
#: Character classes, taken one after the other out of the text; what is left is a class too.
CLASSES = (r"[\p{Ll}]+", r"[\x20\x09-\x0D]+", r"[\p{Lu}]+", r"[0-9]+", r"[.,;:!?'\"()\-]+", r"[#*$%&|<>@^~=+_/\\{}\[\]`]+")
#: Most common words of a language that have a bin of their own.
COMMON = 24
#: Buckets of texts that weigh alike in a reference.
BUCKETS = 64
#: Minimum-length guards: shorter documents are not judged by that histogram.
MIN_CHARS, MIN_WORDS = 200, 50
#: Largest distances a document may have.  A histogram of n draws over b bins is some
#: sqrt(b / n) away from its own source, so the word rule allows that much on top.
MAX_CHARS, MAX_WORDS = 0.25, 0.30


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def repeated_words(df: DataFrame, words: str, out: str, width: int = 3) -> DataFrame:
    """Column ``out``: words inside windows of ``width`` words that occur twice or more, first
    included.

    Leaves the words' hashes in ``_hashes``.  A window is one long: its hash above, its
    position in the low bits (as many as the text needs).  Sorted, equal windows are neighbours; neighbours that agree in the hash are
    compared word by word.  Should two different windows ever share a hash, that text is
    counted again by sorting the words themselves, so the count is exact.
    """
    w, n = F.col(words), F.size(words)
    starts = F.slice(w, 1, F.greatest(n - F.lit(width - 1), F.lit(0)))
    df = df.withColumns({"_bits": F.length(F.bin(n)), "_hashes": F.transform(w, lambda x: F.xxhash64(x))})

    def shifted(x: Column, down: bool) -> Column:  # by a column, which the functions of this name don't take
        return F.call_function("shiftrightunsigned" if down else "shiftleft", x, F.col("_bits"))

    first = F.slice(F.col("_hashes"), 1, F.greatest(n - F.lit(width - 1), F.lit(0)))
    df = df.withColumn("_keys", F.sort_array(F.transform(first, lambda x, i: shifted(
        F.xxhash64(x, *[F.get(F.col("_hashes"), i + F.lit(k)) for k in range(1, width)]), False).bitwiseOR(i.cast("long")))))
    low = shifted(F.lit(-1).cast("long"), False)

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.bitwise_not(low)).cast("int")

    def one_hash(x: Column, y: Column) -> Column:
        return shifted(x.bitwiseXOR(y), True) == 0

    def words_agree(p: Column, q: Column) -> Column:
        return reduce(and_, [F.get(w, p + F.lit(k)) == F.get(w, q + F.lit(k)) for k in range(width)])

    # for each key: 1 if its neighbour above is the same window, -1 if it only has the same hash
    keys = F.col("_keys")
    df = df.withColumn("_next", F.zip_with(keys, F.slice(keys, 2, F.greatest(F.size(keys) - 1, F.lit(0))), lambda x, y: F.when(
        F.coalesce(one_hash(x, y), F.lit(False)), F.when(words_agree(place(x), place(y)), 1).otherwise(-1)).otherwise(0)))
    some = F.array_contains("_next", 1)
    runs = F.filter(keys, lambda x, i: (F.get(F.col("_next"), i) == 1) | F.coalesce(F.get(F.col("_next"), i - F.lit(1)) == 1, F.lit(False)))
    spread = lambda at: F.size(F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(*[p + F.lit(k) for k in range(width)])))))
    fast = F.when(some, spread(F.transform(runs, place))).otherwise(F.lit(0))
    # the exact way round a shared hash: sort (words, position)
    whole = let(F.sort_array(F.transform(starts, lambda x, i: F.struct(F.array(x, *[F.get(w, i + F.lit(k)) for k in range(1, width)]).alias("g"), i.alias("p")))),
                lambda s: spread(F.transform(F.filter(s, lambda x, i: F.coalesce(x["g"] == F.get(s, i - F.lit(1))["g"], F.lit(False))
                                                      | F.coalesce(x["g"] == F.get(s, i + F.lit(1))["g"], F.lit(False))), lambda x: x["p"])))
    return df.withColumn(out, F.when(F.array_contains("_next", -1), whole).otherwise(fast).cast("long")).drop("_bits", "_keys", "_next")


def class_counts(df: DataFrame, text: str, out: str) -> DataFrame:
    """Column ``out``: characters of each class, then all others; with it ``word_chars`` and
    ``n_symbols``.  Each class is cut out of what the classes before it left, so later passes
    read little."""
    rest = text
    for i, c in enumerate(CLASSES):
        df = df.withColumn(f"_rest{i}", F.regexp_replace(F.col(rest), c, ""))
        rest = f"_rest{i}"
    left = [F.length(text), *[F.length(f"_rest{i}") for i in range(len(CLASSES))]]
    counts = [(a - b).cast("long") for a, b in zip(left, left[1:])] + [left[-1].cast("long")]
    symbols = F.length("_rest4") - F.length(F.regexp_replace("_rest4", r"[#*$%&|<>]+", ""))  # what the classes before left of them
    return df.withColumns({out: F.array(*counts), "word_chars": left[0].cast("long") - counts[1], "n_symbols": symbols.cast("long")}).drop(
        *[f"_rest{i}" for i in range(len(CLASSES))])


def bin_counts(hashes: Column, common: Column) -> Column:
    """How often each of ``common`` comes in ``hashes`` (hashes of words): bin 0 is every other
    word.  The bins of all words are sorted together with one mark per bin, so a bin ends at
    its last mark."""
    bins = F.transform(hashes, lambda h: F.array_position(common, h))
    marked = F.sort_array(F.concat(bins, F.sequence(F.lit(0).cast("long"), F.size(common).cast("long"))))
    ends = let(marked, lambda s: F.filter(
        F.transform(s, lambda x, i: F.when(F.coalesce(F.get(s, i + F.lit(1)) != x, F.lit(True)), i + F.lit(1))),
        lambda i: i.isNotNull()))
    return let(ends, lambda e: F.transform(
        e, lambda x, i: (x - F.coalesce(F.when(i > 0, F.get(e, i - F.lit(1))), F.lit(0)) - F.lit(1)).cast("long")))


def common_words(docs: DataFrame, lang: str, text: str, n: int = COMMON) -> DataFrame:
    """``lang, common``: hashes of the ``n`` most frequent words of each language, ties by word."""
    each = docs.select(F.col(lang).alias("lang"), F.explode(F.split(F.col(text), SPACE + "+")).alias("w")).filter("w != ''")
    counts = each.groupBy("lang", "w").agg(F.count("*").alias("c"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), "w"))
    best = counts.withColumn("r", rank).filter(F.col("r") <= n)
    return best.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("r", "w"))).alias("rw")).select(
        "lang", F.transform("rw", lambda x: F.xxhash64(x["w"])).alias("common"))


def shares(counts: Column) -> Column:
    return let(counts, lambda c: let(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x),
                                     lambda n: F.transform(c, lambda x: x.cast("double") / F.greatest(n, F.lit(1)))))


def references(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per language and histogram column the mean of the buckets' shares (empty histograms
    say nothing and are left out)."""
    out = None
    for c in columns:
        bins = rows.select("lang", "bucket", F.posexplode(c).alias("bin", "v"))
        per = bins.groupBy("lang", "bucket", "bin").agg(F.sum("v").alias("v"))
        vec = per.groupBy("lang", "bucket").agg(F.array_sort(F.collect_list(F.struct("bin", "v"))).alias("bv")).select(
            "lang", F.col("bv.v").alias("v"))
        vec = vec.filter(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x) > 0)
        mean = vec.select("lang", F.posexplode(shares(F.col("v"))).alias("bin", "s")).groupBy("lang", "bin").agg(F.avg("s").alias("s"))
        ref = mean.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("bin", "s"))).alias("bs")).select(
            "lang", F.col("bs.s").alias(f"ref_{c}"))
        out = ref if out is None else out.join(ref, "lang", "full")
    return out


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares: square root of the divergence in bits."""
    def term(x: Column, y: Column) -> Column:
        part = lambda a: F.when(a > 0, a * F.log2(a / ((x + y) / F.lit(2.0)))).otherwise(F.lit(0.0))
        return (part(x) + part(y)) / F.lit(2.0)

    total = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def base_counts(docs: DataFrame, text: str = "_text") -> DataFrame:
    """The counts that need no reference, and the words (``_words``), as columns beside ``text``."""
    df = docs.withColumn("_words", words_of(F.col(text)))
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    })
    return class_counts(repeated_words(df, "_words", "n_repeat_words"), text, "_classes")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  max_chars: float = MAX_CHARS, max_words: float = MAX_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, char_distance, word_distance, kept.

    * words are maximal runs of ``[^\\x20\\x09-\\x0D]``; a null text counts as empty (all zero,
      base_failed); whole texts are read, whatever their length, as one row each;
    * base_failed: fewer than 50 words, or more than half of the words repeat;
    * kept: base passed and no judged histogram is farther from its language than allowed.  A
      histogram is judged from ``MIN_CHARS`` word characters or ``MIN_WORDS`` words on;
    * rows without a language are compared with each other (``und``); a language of one text
      is its own reference.  Repeated rows and null ids are kept apart; other columns are
      ignored; an empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    common = stored(common_words(src, "lang", "_text"), "common-words")
    met = base_counts(src.join(common, "lang", "left"))
    met = met.withColumn("_bins", bin_counts(F.col("_hashes"), F.coalesce("common", F.array().cast("array<bigint>"))))
    rows = stored(met.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                             (F.conv(F.substring(F.md5("_text"), 1, 2), 16, 10).cast("int") % BUCKETS).alias("bucket"),
                             "_classes", "_bins"), "rules")
    refs = stored(references(rows, ["_classes", "_bins"]), "references")
    n_bins = F.size("_bins")
    slack = F.sqrt(n_bins / F.greatest(F.col("n_words"), F.lit(1)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = rows.join(refs, "lang", "left").withColumns({
        "base_failed": failed,
        "char_distance": F.when(F.col("word_chars") >= MIN_CHARS, jensen_shannon(shares(F.col("_classes")), F.col("ref__classes"))),
        "word_distance": F.when(F.col("n_words") >= MIN_WORDS, jensen_shannon(shares(F.col("_bins")), F.col("ref__bins"))),
        "_slack": slack / 4,
    })
    far = (F.coalesce(F.col("char_distance") > max_chars, F.lit(False))
           | F.coalesce(F.col("word_distance") > max_words + F.col("_slack"), F.lit(False)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"),
                         (~F.col("base_failed") & ~far).alias("kept"))
