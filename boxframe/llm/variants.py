"""Spelling variants: words one edit apart, by asymmetric q-chunks, and their most frequent forms.

1. Counts. Tasks count the words of their texts in bounded tables, Spark adds
   the counts; words of enough letters and occurrences make the vocabulary.
2. Candidates. Of two words one edit (an inserted, deleted or replaced code
   point) apart, the shorter contributes two disjoint chunks, its halves, and the
   other all its positional grams of the halves' sizes. One edit spoils one
   of the halves at most; the other half stands in the longer word, moved by one
   position at most. So an equi-join on (length of the shorter word, gram,
   position), with each chunk at its position and the next one, finds all
   pairs. Of words of one length the smaller in code-point order is the shorter.
   A parity of the letters filters within the join: one edit flips two bits at most.
3. Verification: the exact edit distance of every candidate.
4. Forms: a word's form is its near word of largest count, if that is at least
   ``factor`` times its own. Counts grow from form to form, so chains end;
   roots are found by pointer doubling, each round a written table.

No table of words passes through the driver: the joins are merges, as the files
of a vocabulary are small enough to be broadcast long after its rows are not.

Defined cases: NULL text has no words; a NULL id is the empty string to
``change``; repeated rows count every time; other columns are ignored, whatever
their names; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import cut_lineage, map_arrow, slices

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words that a task counts before it hands the counts on.
HELD = 200_000
Change = Callable[[object, str], str]


def _count(change: Change | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, "text", 1_000_000):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own: dict[str, int] = {}
                # bytes.lower changes A-Z alone
                for word in LETTERS.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")) if text else ():
                    own[word] = own.get(word, 0) + 1
                for word, n in own.items():
                    if change:
                        word = change(key, word)
                    counts[word] = counts.get(word, 0) + n
            if len(counts) > HELD:
                yield out()
                counts = {}
        if counts:
            yield out()

    return run


def count_words(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """``word, n``: occurrences of the runs of letters (A-Z lower-cased) in all texts of ``docs`` (doc_id, text).

    ``change(doc_id, word)`` may spell a document's word differently.
    """
    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_arrow(kept, _count(change), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _parity(word: Column) -> Column:
    """A bit per code point mod 63: how often it stands in the word, odd or even."""
    letters = F.split(word, "")
    return F.aggregate(letters, F.lit(0).cast("bigint"),
                       lambda bits, c: F.when(c == "", bits).otherwise(bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(c) % 63))))


def chunks(words: DataFrame) -> DataFrame:
    """``size, gram, pos, u, un, up``: both halves of every word, each at its position and at the next one."""
    n = F.length("word")
    half = F.floor(n / 2).cast("int")
    parts = F.array(
        *[F.struct(F.substring(F.col("word"), F.lit(1), half).alias("gram"), F.lit(s).alias("pos")) for s in (0, 1)],
        *[F.struct(F.substring(F.col("word"), half + 1, n - half).alias("gram"), (half + s).alias("pos")) for s in (0, 1)])
    return words.select(n.alias("size"), F.inline(parts), F.col("word").alias("u"), F.col("n").alias("un"), _parity(F.col("word")).alias("up"))


def grams(words: DataFrame) -> DataFrame:
    """``size, gram, pos, v, vn, vp``: all positional grams of every word, of the halves' sizes of words as long or one shorter."""
    n = F.length("word")

    def of(length: Column, size: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - size),
                           lambda i: F.struct(length.alias("size"), F.substring(F.col("word"), i + 1, size).alias("gram"), i.alias("pos")))

    rows = []
    for length in (n, n - 1):
        half = F.floor(length / 2).cast("int")
        rows += [of(length, half), F.when(half * 2 < length, of(length, length - half)).otherwise(F.array().cast(
            "array<struct<size:int,gram:string,pos:int>>"))]
    return words.select(F.inline(F.concat(*rows)), F.col("word").alias("v"), F.col("n").alias("vn"), _parity(F.col("word")).alias("vp"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``u, un, v, vn``: every pair of different words (word, n) one edit apart, once, with their counts.

    ``words`` must be distinct and of at least two code points.
    """
    a, b = chunks(words), grams(words)
    small = F.bit_count(F.col("up").bitwiseXOR(F.col("vp"))) <= 2
    order = (F.length("v") > F.col("size")) | (F.col("u") < F.col("v"))
    # A planner that doesn't know how many grams a word has would broadcast them: merged, whatever it expects.
    found = a.join(b.hint("merge"), ["size", "gram", "pos"]).where(order & small & (F.levenshtein("u", "v", 1) == 1))
    return found.select("u", "un", "v", "vn").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the words that have a form: pointers are doubled until none moves."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        hop = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        then = cut_lineage(now.join(hop.hint("merge"), "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        moved = then.where("_moved").limit(1).count()
        now = then.drop("_moved")
        if not moved:
            return now


def group_variants(counts: DataFrame, letters: int = 5, occurrences: int = 3, factor: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``counts`` (word, n) with enough letters and occurrences.

    Near words differ by exactly one edit. ``form`` is the near word of largest
    count (ties: smallest in code-point order) if that count is at least
    ``factor`` times the word's own, else NULL; ``root`` is the last of the chain of forms.
    """
    enough = (F.length("word") >= letters) & (F.col("n") >= occurrences)
    words = cut_lineage(counts.where(enough).select("word", F.col("n").cast("bigint").alias("n")), "words")
    pairs = cut_lineage(near_pairs(words), "near")
    both = pairs.select(F.col("u").alias("word"), F.col("un").alias("n"), F.struct((-F.col("vn")).alias("m"), F.col("v").alias("w")).alias("other"))
    both = both.unionByName(pairs.select(F.col("v").alias("word"), F.col("vn").alias("n"), F.struct((-F.col("un")).alias("m"), F.col("u").alias("w")).alias("other")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min("other").alias("other"))
    strong = -F.col("other.m") >= factor * F.col("n")
    near = cut_lineage(best.select("word", "n_near", F.when(strong, F.col("other.w")).alias("form"),
                                   F.when(strong, -F.col("other.m")).alias("form_n")), "forms")
    known = near.join(_roots(near.where("form is not null")).hint("merge"), "word", "left")
    return words.join(known.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
