"""Quality rules: base rules and divergence from a language's usual make-up.

Per document two histograms are counted: characters by class and common words by
word. A language's reference is the sum of its documents that pass the base
rules. A document whose Jensen-Shannon distance (base 2, from 0 to 1) to its
reference exceeds a limit is rejected, if the reference is long enough to say so.
Short texts are far from any reference by chance, so the limits come from the corpus:
per language and band of lengths a multiple of the median distance of the documents
that pass the base rules, within fixed bounds. A band of few documents has the upper
bound.

Everything is DataFrame functions; a document's trigrams are compared by a 64-bit
hash inside its own row, so no words are shuffled.

Defined cases: a null text has no words and fails the base rules; null is a
language of its own; repeated rows get the same verdict; a language whose
reference is too short rejects nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.scratch import written

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEATED_PCT = 50
#: The characters of a document are judged from so many on; its words always are.
MIN_JUDGED_CHARS = 250
#: A reference counts from so many words on.
MIN_REFERENCE_WORDS = 5_000
#: Limits are so many times the median distance, but within these bounds.
CLASS_TIMES_MEDIAN, WORD_TIMES_MEDIAN = 2.0, 1.5
LEAST_CLASS_LIMIT, LEAST_WORD_LIMIT = 0.2, 0.24
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.31
#: A band has limits of its own from so many documents on; medians are exact to one step.
MIN_BAND_DOCS = 20
STEPS = 1000

# Character classes as patterns; what is left is a class of its own.
CLASSES = {
    "lower_or_space": r"[a-z\x20\x09-\x0D]+",
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "symbol": r"[#*$%&|<>]+",
    "punct": r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]+",
}

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "with", "this", "be", "are",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "nicht", "ein",
    "le", "la", "les", "et", "est", "un", "une", "du", "que", "dans", "pour", "pas", "au",
    "el", "los", "las", "del", "por", "con", "para", "una", "se", "no", "su", "al", "y",
)


def js_distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of counts; null if one has no counts."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    shares = lambda a: F.transform(a, lambda x: F.try_divide(x.cast("double"), total(a)))
    half = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(shares(left), shares(right), lambda p, q: half(p, (p + q) / 2) + half(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2))


def _codes(words: tuple[str, ...]) -> tuple[int, dict[str, int]]:
    """The least seed for which crc32 gives every word a code of its own from 0 to 179."""
    for seed in range(1_000_000):
        codes = {w: zlib.crc32(f"{seed}{w}".encode()) % 180 for w in words}
        if len(set(codes.values())) == len(words):
            return seed, codes
    raise ValueError("too many common words")


def quality_features(docs: DataFrame) -> DataFrame:
    """``row`` and ``lang`` with the base counts and the two histograms."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.struct("*").alias("row"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    # The commonest classes go first, so the later patterns run over what little is left.
    counted, left = base.withColumn("n_chars", F.length("text").cast("long")), "text"
    for name, pattern in CLASSES.items():
        counted = counted.withColumn(f"no_{name}", F.regexp_replace(left, pattern, ""))
        counted = counted.withColumn(f"c_{name}", (F.length(left) - F.length(f"no_{name}")).cast("long"))
        left = f"no_{name}"
    counted = counted.withColumn("c_other", F.length(left).cast("long")).drop(*[f"no_{c}" for c in CLASSES])

    spaced = F.col("text")
    for space in SPACE[1:]:
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    counted = counted.withColumn("spaced", spaced)
    counted = counted.withColumn("c_space", F.length("spaced") - F.length(F.replace("spaced", F.lit(" "), F.lit(""))))
    counted = counted.withColumn("words", F.array_remove(F.split("spaced", " "), ""))
    n = F.size("words")
    counted = counted.withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    hashed = lambda i: F.get(F.col("word_hashes"), i)
    hashes = F.transform("word_hashes", lambda h, i: F.xxhash64(h, hashed(i + 1), hashed(i + 2)))
    hashes = F.slice(hashes, F.lit(1), n - 2)
    counted = counted.withColumn("hashes", F.when(n >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
    grams = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    counted = counted.withColumn("grams", F.when(some, grams))
    at = lambda j: F.get(F.col("grams"), j)["h"]
    starts = F.transform(
        F.filter("grams", lambda g, j: g["h"].eqNullSafe(at(j - 1)) | g["h"].eqNullSafe(at(j + 1))), lambda g: g["i"]
    )
    repeated = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    seed, codes = _codes(COMMON_WORDS)
    forms = sorted({form for w in COMMON_WORDS for form in (w, w.capitalize(), w.upper())})
    code = lambda w: F.crc32(F.concat(F.lit(str(seed)), F.lower(w)).cast("binary")) % 180
    found = F.filter("words", lambda w: w.isin(forms))
    counted = counted.withColumn("found", F.array_join(F.transform(found, lambda w: F.char(code(w) + 48)), ""))
    of_word = lambda w: F.length("found") - F.length(F.replace("found", F.lit(chr(codes[w] + 48)), F.lit("")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    counted = counted.withColumn("lines", lines)
    rest_of_first = F.col("c_lower_or_space") - F.col("c_space")
    classes = [rest_of_first, *[F.col(f"c_{c}") for c in list(CLASSES)[1:]]]
    return counted.select(
        "row",
        "lang",
        n.cast("long").alias("n_words"),
        (F.col("n_chars") - F.col("c_space")).alias("word_chars"),
        F.col("c_symbol").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("grams").isNull(), 0).otherwise(repeated).cast("long").alias("n_repeat_words"),
        F.array(*classes, "c_space", "c_other").cast("array<bigint>").alias("class_counts"),
        F.array(*[of_word(w) for w in COMMON_WORDS], n - F.length("found")).cast("array<bigint>").alias("word_counts"),
    )


def with_distances(features: DataFrame, references: DataFrame) -> DataFrame:
    return (
        features.join(references, F.col("lang").eqNullSafe(F.col("reference_lang")), "left")
        .withColumn("class_distance", js_distance(F.col("class_counts"), F.col("class_reference")))
        .withColumn("word_distance", js_distance(F.col("word_counts"), F.col("word_reference")))
        .withColumn("band", F.floor(F.log2(F.col("n_words") / MIN_WORDS)))
    )


def distance_limits(passed: DataFrame, max_class_distance: float, max_word_distance: float) -> DataFrame:
    """``limit_lang``, ``limit_band`` and both limits, from the documents that pass the base rules.

    Distances are counted in steps first, so a group's state has at most ``STEPS`` entries.
    """
    step = lambda c: F.floor(F.col(c) * STEPS).alias(c)
    counts = passed.groupBy("lang", "band", step("class_distance"), step("word_distance")).agg(F.count("*").alias("n"))
    median = lambda c: F.percentile(c, 0.5, F.col("n")) / STEPS

    def limit(c: str, times: float, least: float, most: float) -> Column:
        inside = F.least(F.greatest(times * median(c), F.lit(least)), F.lit(most))
        return F.when(F.sum("n") >= MIN_BAND_DOCS, inside).otherwise(F.lit(most))

    return counts.groupBy(F.col("lang").alias("limit_lang"), F.col("band").alias("limit_band")).agg(
        limit("class_distance", CLASS_TIMES_MEDIAN, LEAST_CLASS_LIMIT, max_class_distance).alias("class_limit"),
        limit("word_distance", WORD_TIMES_MEDIAN, LEAST_WORD_LIMIT, max_word_distance).alias("word_limit"),
    )


def judge_quality(
    docs: DataFrame,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """``row`` with the counts, ``base_failed``, both distances and ``kept``.

    ``max_class_distance`` and ``max_word_distance`` are the upper bounds of the limits.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words"))
    features = written(quality_features(docs).withColumn("base_failed", failed), "quality-features")
    n_classes, n_bins = len(CLASSES) + 2, len(COMMON_WORDS) + 1
    sums = lambda c, size: F.array(*[F.sum(F.get(F.col(c), F.lit(k))) for k in range(size)])
    references = (
        features.where(~F.col("base_failed"))
        .groupBy(F.col("lang").alias("reference_lang"))
        .agg(
            F.sum("n_words").alias("reference_words"),
            sums("class_counts", n_classes).alias("class_reference"),
            sums("word_counts", n_bins).alias("word_reference"),
        )
    )
    references = written(references, "quality-references")
    enough = F.coalesce(F.col("reference_words") >= MIN_REFERENCE_WORDS, F.lit(False))
    chars = F.aggregate("class_counts", F.lit(0).cast("bigint"), lambda s, x: s + x)
    passed = features.where(~F.col("base_failed")).select("lang", "n_words", "class_counts", "word_counts")
    limits = distance_limits(with_distances(passed, references), max_class_distance, max_word_distance)
    limits = written(limits, "quality-limits")
    same_band = F.col("lang").eqNullSafe(F.col("limit_lang")) & (F.col("band") == F.col("limit_band"))
    far = lambda guard, kind: F.coalesce(
        enough & guard & (F.col(f"{kind}_distance") > F.col(f"{kind}_limit")), F.lit(False)
    )
    return (
        with_distances(features, references)
        .join(limits, same_band, "left")
        .withColumn("rejected", far(chars >= MIN_JUDGED_CHARS, "class") | far(F.lit(True), "word"))
        .select(
            "row",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & ~F.col("rejected")).alias("kept"),
            "class_distance",
            "word_distance",
        )
    )


def good_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return judge_quality(docs, **options).where("kept").select("row.*")
