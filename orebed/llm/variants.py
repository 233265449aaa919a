"""Spelling variants: words one letter apart, found by PartEnum signatures.

A word's letters are a multiset, that is a set of (letter, how manieth). One letter
put in or left out changes this set in one place, one replaced in two, so words
that are near differ in two places at most. The places are dealt to ``PARTS``
parts; two such sets agree on all but two parts at least. A signature is a hash of
what a word has outside two parts: near words share one, whichever two parts
differ. Words that share a signature are verified letter by letter.

Defined results: a null text has no words; a null id is the empty text in a word's
draw; repeated rows count again; an empty table gives no words; other columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import stored

LETTERS = "A-Za-zÀ-ÿ"
PARTS = 8
# A form is at least so many times as frequent as the word, so a chain of forms grows by that factor a step.
FACTOR = 5


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case; other letters stay. Whole-text lower-casing is the quick way where all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def word_counts(docs: DataFrame, every: int, least_length: int, least_count: int, text: str = "text") -> DataFrame:
    """(word, n) of the words of whole texts, with a letter left out of one in ``every``.

    A run is a word unless ``every`` divides the checksum of ``<doc_id>:<run>``, which
    then also says which letter goes. Counted in each task before anything moves.
    """
    # A run shorter than the least length cannot become long enough.
    pattern = F.lit(f"[{LETTERS}]{{{least_length},}}")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col(text), pattern, F.lit(0))).alias("_run"))
    runs = runs.select("doc_id", lower_ascii(F.col("_run")).alias("_run"))
    keyed = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("_run"))
    drawn = runs.select("_run", F.crc32(keyed.cast("binary")).alias("_h"))
    place = (F.col("_h") % F.char_length("_run")).cast("int")
    shorter = F.concat(F.substring("_run", F.lit(1), place), F.substring("_run", place + 2, F.char_length("_run")))
    word = F.when(F.col("_h") % every == 0, shorter).otherwise(F.col("_run"))
    words = drawn.select(word.alias("word")).filter(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def signatures(word: Column) -> Column:
    """The hashes two words share if their letter multisets differ in at most two places."""
    letters = F.sort_array(F.split(word, ""))
    # Equal letters stand together: how manieth a letter is follows from where its kind begins.
    places = F.transform(letters, lambda x, i: F.concat(x, (i + 2 - F.array_position(letters, x)).cast("string")))
    def part(number: int) -> Column:
        return F.array_join(F.filter(places, lambda x: F.crc32(x.cast("binary")) % PARTS == number), " ")

    return F.array(*[part(number) for number in range(PARTS)])


def signed(words: DataFrame) -> DataFrame:
    """A row per word and signature."""
    parts = words.withColumn("_parts", signatures(F.col("word")))

    def outside(two: tuple[int, int]) -> Column:
        rest = [F.col("_parts")[number] for number in range(PARTS) if number not in two]
        return F.xxhash64(F.lit(two[0] * PARTS + two[1]), *rest)

    hashes = F.array(*[outside(two) for two in combinations(range(PARTS), 2)])
    return parts.select("word", "n", F.explode(hashes).alias("_sig"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): each pair of words one letter apart, in both directions.

    The join is on the signature and verifies within; a signature that very many
    words share is split by the join itself. A pair found by several signatures
    is made one.
    """
    marked = stored(signed(words), "signatures")
    one = marked.select("word", "n", "_sig")
    two = marked.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("_sig").alias("_other"))
    apart = F.levenshtein(F.col("word"), F.col("near"), 1) == 1
    met = one.join(two, (F.col("_sig") == F.col("_other")) & (F.col("word") < F.col("near")) & apart)
    pairs = met.select("word", "n", "near", "near_n").distinct()
    both = F.array(
        F.struct("word", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the form at the end of each chain.

    Each round makes every step twice as long, until none leads further.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = steps.join(after, F.col("root") == F.col("_at"), "left")
        if further.filter(F.col("_next").isNotNull()).isEmpty():
            return steps
        steps = stored(further.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def group_variants(
    docs: DataFrame, every: int = 199, least_length: int = 6, least_count: int = 5, text: str = "text"
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus.

    A word's form is its most frequent near word (ties: the first in code point
    order) if that is ``FACTOR`` times as frequent; its root is the end of the
    chain of forms, or the word itself.
    """
    words = stored(word_counts(docs, every, least_length, least_count, text), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best"))
    taken = -F.col("_best.less") >= FACTOR * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        F.when(taken, F.col("_best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, -F.col("_best.less")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    ends = roots(formed.filter(F.col("form").isNotNull()))
    found = formed.join(ends, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
