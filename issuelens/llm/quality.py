"""Quality rules: base measures of a text, and its divergence from references of its language.

Built-in expressions only. A document is compared with the character-class histogram and the
common-word histogram of its `lang` value by Jensen-Shannon distance (base 2, so between 0 and 1).
The word reference is a sum over all documents. The class reference is built twice: over all
documents, and then over those that pass the base rule and lie within `trim` of the first one, so
that texts full of symbols don't pull it towards themselves.

A sample of n words lies at a distance of the order 1 / sqrt(n) from the distribution it is drawn
from, so each limit is a constant plus a slack divided by the root of the number of words: short texts
are judged too, by wider limits.

Edge cases: a null or empty text has no words and fails the base rule. A null `lang` counts
with the empty one as a language of its own. A language with fewer than `min_docs` documents in its
trimmed reference, or beyond the `MAX_LANGUAGES` largest, has no reference: its documents keep the base verdict.
Texts with fewer than `min_words` words are not judged by the class histogram, those with fewer words of letters
not by the word histogram. Long texts are read whole. Repeated rows are measured each for itself; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from issuelens.llm.common import SPACES, stored, words

SYMBOLS = "[#*$%&|<>]+"
WINDOW = 5
# Character classes in the order they are taken out of a text; what remains is the last class.
CLASSES = ["[a-z]+", SPACES, "[A-Z]+", SYMBOLS, "[0-9]+", r"\p{L}+", r"\p{Punct}+"]
COMMON_WORDS = 16
# More than there are language codes; bounds what is broadcast to some MB, whatever a dirty column holds.
MAX_LANGUAGES = 10_000


def class_counts(text: Column) -> list[tuple[str, Column]]:
    """Successive remainders of the text: each has one class less than the one before."""
    steps, rest = [], text
    for k, pattern in enumerate(CLASSES):
        steps.append((f"rest{k}", F.regexp_replace(rest, pattern, "")))
        rest = F.col(f"rest{k}")
    return steps


def with_classes(df: DataFrame) -> DataFrame:
    """Adds `classes`, the number of code points of the text in each class."""
    kept = df.columns
    for name, expression in class_counts(F.col("text")):
        df = df.withColumn(name, expression)
    lengths = [F.length("text"), *(F.length(f"rest{k}") for k in range(len(CLASSES)))]
    counts = [a - b for a, b in zip(lengths, lengths[1:])] + [lengths[-1]]
    return df.select(*kept, F.transform(F.array(*counts), lambda c: c.cast("long")).alias("classes"))


def base_measures(df: DataFrame) -> DataFrame:
    """Adds the base measures to rows with a non-null `text` and its `classes`; both are kept."""
    kept = df.columns
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(*kept, words(F.col("text")).alias("words"), lines.alias("lines"))
    # Window i holds the words i to i + 4; equal windows have equal keys, and only texts with equal keys go on.
    shifted = [F.slice("words", k + 1, F.greatest(F.size("words") - WINDOW + 1, F.lit(0))).alias(f"w{k}") for k in range(WINDOW)]
    df = df.withColumn("windows", F.arrays_zip(*shifted)).withColumn(
        "keys", F.transform("windows", lambda w: F.xxhash64(w))
    )
    placed = F.transform(
        F.arrays_zip("keys", "windows"),
        lambda w, i: F.struct(w["keys"].alias("key"), w["windows"].alias("w"), i.alias("i")),
    )
    suspect = F.size(F.array_distinct("keys")) < F.size("keys")
    df = df.withColumn("sorted", F.when(suspect, F.sort_array(placed)).otherwise(F.slice(placed, 1, 0)))
    last = F.greatest(F.size("sorted") - 1, F.lit(0))
    df = df.withColumn("next", F.arrays_zip(F.slice("sorted", 1, last).alias("a"), F.slice("sorted", 2, last).alias("b")))
    equal = F.filter("next", lambda p: (p.a.key == p.b.key) & (p.a.w == p.b.w))
    places = F.sort_array(F.array_distinct(F.flatten(F.transform(equal, lambda p: F.array(p.a.i, p.b.i)))))
    df = df.withColumn("places", places)
    last = F.greatest(F.size("places") - 1, F.lit(0))
    steps = F.arrays_zip(F.slice("places", 1, last).alias("a"), F.slice("places", 2, last).alias("b"))
    covered = F.aggregate(steps, F.lit(0), lambda n, p: n + F.least(F.lit(WINDOW), p.b - p.a))
    repeat = F.when(F.size("places") == 0, 0).otherwise(covered + WINDOW).cast("long")
    df = df.select(
        *kept,
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.col("classes")[CLASSES.index(SPACES)]).alias("word_chars"),
        F.col("classes")[CLASSES.index(SYMBOLS)].alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def letter_words(text: Column) -> Column:
    """Lower-cased runs of letters, in order, as an array; its first and its last element may be empty."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def n_letter_words(letters: Column) -> Column:
    """Number of elements of `letter_words` that are not empty."""
    last = (F.size(letters) > 1) & (F.element_at(letters, -1) == "")
    return F.size(letters).cast("long") - (F.element_at(letters, 1) == "").cast("long") - last.cast("long")


def word_references(texts: DataFrame) -> DataFrame:
    """(key, ref_words, ref_counts, ref_longest, ref_total): the most common words of each language with the length of the
    longest, and all its words of letters.

    At most MAX_LANGUAGES rows with COMMON_WORDS words each, whatever the size of `texts`.
    """
    word = F.explode(letter_words(F.col("text"))).alias("word")
    counted = texts.select("key", word).where(F.length("word") >= 1).groupBy("key", "word").agg(F.count(F.lit(1)).alias("c"))
    order = W.partitionBy("key").orderBy(F.desc("c"), "word")
    top = counted.withColumn("r", F.row_number().over(order)).where(F.col("r") <= COMMON_WORDS)
    lists = top.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("r", "word", "c"))).alias("top"))
    totals = counted.groupBy("key").agg(F.sum("c").alias("ref_total"))
    return (
        totals.orderBy(F.desc("ref_total"), "key")
        .limit(MAX_LANGUAGES)
        .join(lists, "key")
        .select(
            "key", "ref_total", F.col("top.word").alias("ref_words"), F.col("top.c").alias("ref_counts"),
            F.array_max(F.transform("top", lambda t: F.length(t["word"]))).alias("ref_longest"),
        )
    )


def class_references(measured: DataFrame, min_docs: int) -> DataFrame:
    """(key, ref_classes) of the languages with enough documents; at most MAX_LANGUAGES rows."""
    sums = [F.sum(F.col("classes")[k]) for k in range(len(CLASSES) + 1)]
    return (
        measured.groupBy("key")
        .agg(F.count(F.lit(1)).alias("docs"), F.array(*sums).alias("ref_classes"))
        .where(F.col("docs") >= min_docs)
        .orderBy(F.desc("docs"), "key")
        .limit(MAX_LANGUAGES)
        .drop("docs")
    )


def trimmed_references(measured: DataFrame, min_docs: int, trim: float) -> DataFrame:
    """(key, ref_classes) summed over the documents that pass the base rule and lie near the sum of all documents."""
    compared = measured.select("key", "classes", "base_failed").join(F.broadcast(class_references(measured, 1)), "key")
    distance = F.round(js_distance(shares(F.col("classes")), shares(F.col("ref_classes"))), 6)
    return class_references(compared.where(~F.col("base_failed") & (distance <= trim)).drop("ref_classes"), min_docs)


def with_rest(counts: Column, total: Column) -> Column:
    """The counts and, last, what is left of the total."""
    return F.concat(counts, F.array(total - F.aggregate(counts, F.lit(0).cast("long"), lambda s, c: s + c)))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c)
    return F.transform(counts, lambda c: F.when(total > 0, c / total).otherwise(0.0))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t), F.lit(0.0)))


def quality(
    docs: DataFrame,
    class_limit: float = 0.12,
    class_slack: float = 0.5,
    word_limit: float = 0.02,
    word_slack: float = 2.66,
    trim: float = 0.2,
    min_words: int = 20,
    min_docs: int = 50,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id with the base measures, both distances (null if not judged) and `kept`, one row per document.

    kept = not base_failed and no judged distance above limit + slack / sqrt(n), where n counts the words for the class
    distance and the words of letters for the word distance; each is judged from n = `min_words` on. The default slack
    of words is the 0.999 quantile for samples of COMMON_WORDS + 1 cells: sqrt(39.3 / (8 ln 2)) = 2.66. Columns
    of `docs` named in `carry` come along unchanged, so that a filter needs no join.
    """
    taken = F.struct(*carry).alias("carried") if carry else F.lit(None).alias("carried")
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("key"), F.coalesce("text", F.lit("")).alias("text"), taken)
    measured = base_measures(with_classes(texts)).withColumn("letters", letter_words(F.col("text")))
    measured = measured.join(F.broadcast(word_references(texts.select("key", "text"))), "key", "left")
    measured = measured.withColumn("n_letter_words", n_letter_words(F.col("letters")))
    # Words longer than the longest word of the reference are no hits, so they are left out of the search once.
    measured = measured.withColumn("letters", F.filter("letters", lambda w: F.length(w) <= F.col("ref_longest")))
    hits = F.transform("ref_words", lambda w: F.size("letters") - F.size(F.array_remove(F.col("letters"), w)))
    measured = measured.withColumn("hits", F.transform(hits, lambda n: n.cast("long")))
    # The texts are left behind here: what follows reads a few numbers per document.
    measured = measured.drop("text", "letters", "ref_longest", "ref_words", *(() if carry else ("carried",)))
    measured = stored(measured, "quality")
    judged = measured.join(F.broadcast(trimmed_references(measured, min_docs, trim)), "key", "left")
    judged = judged.withColumn("here", with_rest(F.col("hits"), F.col("n_letter_words")))
    judged = judged.withColumn("there", with_rest(F.col("ref_counts"), F.col("ref_total")))
    judged = judged.withColumn("p", shares(F.col("here"))).withColumn("q", shares(F.col("there")))
    judged = judged.withColumn("pc", shares(F.col("classes"))).withColumn("qc", shares(F.col("ref_classes")))
    known = F.col("ref_classes").isNotNull()
    by_class = known & (F.col("n_words") >= min_words)
    by_word = known & F.col("ref_total").isNotNull() & (F.col("n_letter_words") >= min_words)
    judged = judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_letter_words",
        *(["carried"] if carry else []),
        F.when(by_class, F.round(js_distance(F.col("pc"), F.col("qc")), 6)).alias("class_distance"),
        F.when(by_word, F.round(js_distance(F.col("p"), F.col("q")), 6)).alias("word_distance"),
    )
    # A distance that is not judged is null and never far.
    far_class = F.col("class_distance") > class_limit + class_slack / F.sqrt("n_words")
    far_word = F.col("word_distance") > word_limit + word_slack / F.sqrt("n_letter_words")
    far = F.coalesce(far_class, F.lit(False)) | F.coalesce(far_word, F.lit(False))
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~far)
    return judged.select("*", "carried.*").drop("carried") if carry else judged
