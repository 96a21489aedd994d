"""Quality rules by distribution divergence (operator 9), in Spark SQL functions only.

Every document gets two histograms: character classes (capitals, digits, sentence marks, symbols, other visible
characters, white space) and common words (each of a fixed list, and all others). A language's reference is the sum
of the histograms of all its documents that pass the base rules. A document is dropped if the Jensen-Shannon
divergence (in bits) between it and its reference is above a limit for either histogram. The limit grows for short
documents by what sampling alone makes a short text differ from its source, and documents below ``min_words`` words
are not judged by it at all: the base rules decide on them.

Null and empty texts have no words and fail the base rules; a null language is a language of its own; repeated rows
are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.runtime import settle

# Frequent words of English, French, German and Spanish.
COMMON_WORDS = (
    "the of and to in a is that for it was on with as are this by be de la le les et des en un une du que est der die und den von "
    "zu das mit dem ein el los las del con por se y"
).split()
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words
WINDOW = 8
MIN_JUDGED_WORDS = 50
MAX_CHAR_DIVERGENCE = 0.05
MAX_WORD_DIVERGENCE = 0.04
SHORT_CHARS, SHORT_WORDS = 2.0, 4.0  # allowances over the number of characters or words


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that the document has twice or more."""

    def in_windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def at_twins(ordered: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                before, after = F.get(ordered, k - 1)["h"], F.get(ordered, k + 1)["h"]
                return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

            return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            _let(placed, at_twins), start,
            lambda a, p: F.struct((a["n"] + p + window - F.greatest(p, a["end"])).alias("n"), (p + window).alias("end")), lambda a: a["n"],
        )

    def of(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered(windows)).otherwise(0)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > window, _let(_let(hashed, in_windows), of)).otherwise(0).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def common_word_counts(words: Column) -> Column:
    """How often each common word occurs, and in the end how many words are none of them."""
    known = F.filter(F.transform(words, lambda w: F.lower(w)), lambda w: w.isin(COMMON_WORDS))
    listed = F.array(*map(F.lit, COMMON_WORDS))
    signs = F.array_join(F.transform(known, lambda w: F.chr(F.array_position(listed, w) + 64)), "")

    def counts(found: Column) -> Column:
        each = [F.length(found) - F.length(F.replace(found, F.lit(chr(65 + i)), F.lit(""))) for i in range(len(COMMON_WORDS))]
        return F.array(*each, F.size(words) - F.length(found))

    return _let(signs, counts)


def character_counts(text: Column, word_chars: Column, symbols: Column) -> Column:
    capitals, digits, marks = (F.length(F.regexp_replace(text, p, "")) for p in (r"\P{Lu}+", "[^0-9]+", "[^.,;:!?]+"))
    others = word_chars - capitals - digits - marks - symbols
    return F.array(capitals, digits, marks, symbols, others, F.length(text) - word_chars)


def divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon divergence in bits of a histogram and a reference distribution."""

    def part(p: Column, other: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + other))).otherwise(0.0)

    def of(total: Column) -> Column:
        terms = F.zip_with(counts, reference, lambda c, q: part(c / total, q) + part(q, c / total))
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2

    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
    return _let(total, lambda n: F.when(n > 0, of(n)).otherwise(0.0))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The counts that all rules need, in one scan."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), text.alias("text"), words_of(text).alias("words"))
    rows = rows.select(
        "doc_id", "lang", "text", F.size("words").cast("long").alias("n_words"), F.length(_without(F.col("text"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        _let(F.col("words"), lambda w: F.struct(repeated_words(w).alias("repeated"), common_word_counts(w).alias("common"))).alias("by_word"),
    )
    rows = rows.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.col("by_word.repeated").alias("n_repeat_words"),
        character_counts(F.col("text"), F.col("word_chars"), F.col("n_symbols")).cast("array<long>").alias("characters"),
        F.col("by_word.common").cast("array<long>").alias("common"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def references(measured: DataFrame) -> DataFrame:
    """Each language's two distributions, from all its documents that pass the base rules (half a count is added to each cell)."""
    passed = measured.where(~F.col("base_failed"))
    sizes = {"characters": 6, "common": len(COMMON_WORDS) + 1}
    sums = [F.sum(F.get(F.col(name), F.lit(i))).alias(f"{name}_{i}") for name, size in sizes.items() for i in range(size)]
    summed = passed.groupBy("lang").agg(*sums)
    shares = []
    for name, size in sizes.items():
        cells = [F.col(f"{name}_{i}") + F.lit(0.5) for i in range(size)]
        total = sum(cells[1:], cells[0])
        shares.append(F.array(*[c / total for c in cells]).alias(f"{name}_reference"))
    return summed.select("lang", *shares)


def apply_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_judged_words: int = MIN_JUDGED_WORDS,
    max_char_divergence: float = MAX_CHAR_DIVERGENCE, max_word_divergence: float = MAX_WORD_DIVERGENCE,
) -> DataFrame:
    """doc_id, the counts of the base rules, base_failed, both divergences and kept."""
    measured = settle(measure(docs, id_col, text_col, lang_col))
    rows = measured.join(references(measured), "lang", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce(divergence(F.col("characters"), F.col("characters_reference")), F.lit(0.0)).alias("char_divergence"),
        F.coalesce(divergence(F.col("common"), F.col("common_reference")), F.lit(0.0)).alias("word_divergence"),
    )
    # A sample of n from a source with K cells differs from it by (K - 1) / (8 n ln 2) bits on average; the
    # allowance is about twice that for the dozen cells that one language fills.
    char_limit = max_char_divergence + SHORT_CHARS / F.col("word_chars")
    word_limit = max_word_divergence + SHORT_WORDS / F.col("n_words")
    near = (F.col("char_divergence") <= char_limit) & (F.col("word_divergence") <= word_limit)
    return rows.withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") < min_judged_words) | near))
