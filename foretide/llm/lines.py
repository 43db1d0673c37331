"""Deleting later copies of repeated line runs, with DataFrame operations only.

Every line gets a number; a document is then a sequence of numbers and each line starts a suffix. Prefix doubling
sorts the suffixes by their first 1, 2, 4, ... lines: a suffix's rank at 2h is the place of the pair (rank at h of the
suffix, rank at h of the suffix h lines on) in the order of all pairs. Suffixes of equal rank at h share h lines; they
are the intervals of the suffix array with common prefixes of at least h. An interval of one suffix is final and
leaves the computation. In every interval at the wanted depth all but the first suffix start a later copy, and the
copies' overlap makes up the maximal repeated runs.

Document order is (doc_id, hash of the text); a null doc_id comes last. Rows that agree in doc_id and text are one
document and get the same result. Null text counts as empty, an empty text is one empty line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretide.session import stable

# A run of this many lines is repeated when it occurs earlier ...
RUN_LINES = 2
# ... and so is one line alone that has this many words.
ALONE_WORDS = 8
# Words of a line by any white space. In scripts without spaces two Han or kana characters, or four of the others, are one.
_PAIRS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\u3001-\u303f\u30fc\uff01-\uff65"
_FOURS = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
_WORD = rf"(?U)[{_PAIRS}]{{1,2}}|[{_FOURS}]{{1,4}}|[^\s{_PAIRS}{_FOURS}]+"
_AT = ["d", "t", "n"]  # document, its text's hash, line


def _identity(doc_id: Column, text: Column) -> list[Column]:
    last = F.lit(2**63 - 1)
    return [F.coalesce(doc_id.cast("long"), last).alias("d"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t")]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Suffixes whose keys others share, with `rank`: the place of their keys in the order of all shared keys, and
    `first`: where the interval's first suffix starts."""
    groups = suffixes.groupBy(*keys).agg(F.count("*").alias("members"), F.min(F.struct(*_AT)).alias("first"))
    shared = groups.where("members > 1")
    # After a range sort this id grows with the order of the keys.
    placed = shared.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stable(placed.withColumn("rank", F.monotonically_increasing_id()).drop("members"))
    return stable(suffixes.join(placed, keys).drop(*keys))


def repeats(docs: DataFrame, run_lines: int = RUN_LINES, alone_words: int = ALONE_WORDS, any_space: bool = False) -> DataFrame:
    """(d, t, n) of the lines to delete: those in a later copy of a repeated run.

    Words are blanks + 1, as in the SQL twin; with `any_space` a line is also long by its words in any script.
    """
    texts = docs.select(*_identity(F.col("doc_id"), F.col("text")), _lines(F.col("text")).alias("lines"))
    every = texts.select("d", "t", F.posexplode("lines").alias("n", "line"))
    blanks = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    long = blanks + 1 >= alone_words
    if any_space:
        long |= F.regexp_count("line", F.lit(_WORD)) >= alone_words
    every = every.select(
        *_AT, F.xxhash64("line").alias("h"), F.xxhash64(F.lit("second"), "line").alias("g"), long.alias("long"),
    )
    every = stable(every.distinct())  # two 64-bit hashes stand for a line
    ranks = _ranked(every, ["h", "g"])
    alone = ranks.where(F.col("long") & (F.col("first") < F.struct(*_AT))).select(*_AT)
    depth = 1
    while depth < run_lines and not ranks.isEmpty():
        step = min(depth, run_lines - depth)  # the last step overlaps unless run_lines is a power of two
        after = ranks.select("d", "t", (F.col("n") - step).alias("n"), F.col("rank").alias("right"))
        pairs = ranks.select(*_AT, F.col("rank").alias("left")).join(after, _AT)
        ranks = _ranked(pairs, ["left", "right"])
        depth += step
    if depth < run_lines:
        return alone.distinct()
    later = ranks.where(F.col("first") < F.struct(*_AT))
    within = F.explode(F.sequence(F.col("n"), F.col("n") + run_lines - 1)).alias("n")
    return alone.union(later.select("d", "t", within)).distinct()


def marked(docs: DataFrame, run_lines: int = RUN_LINES, alone_words: int = ALONE_WORDS, any_space: bool = False) -> DataFrame:
    """docs with `kept`, the text without its repeated lines, `n_lines` and `n_deleted`."""
    gone = repeats(docs, run_lines, alone_words, any_space).groupBy("d", "t").agg(F.sort_array(F.collect_list("n")).alias("gone"))
    names = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    own = own.withColumns(dict(zip(("d", "t"), _identity(F.col("row.doc_id"), F.col("row.text")), strict=True)))
    both = own.join(gone, ["d", "t"], "left")
    held = F.struct(_lines(F.col("row.text")).alias("lines"), "gone")
    # The lambda's variable keeps the split from being repeated for every line.
    kept = F.transform(
        F.array(held),
        lambda h: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(h.lines) - 1), h.gone), lambda i: F.get(h.lines, i)
            ),
            "\n",
        ),
    )[0]
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return both.select(
        "row",
        F.when(F.col("gone").isNull(), text).otherwise(kept).alias("kept"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_deleted"),
    )


def drop_repeats(docs: DataFrame, run_lines: int = RUN_LINES, alone_words: int = ALONE_WORDS) -> DataFrame:
    """docs with their texts' repeated lines deleted, words told by any white space; documents that lose every line go.

    All columns stay as they are but for `text`, and `n_chars` where there is one and a line went. A document
    without repeats, null and empty texts included, stays unchanged.
    """
    found = marked(docs, run_lines, alone_words, any_space=True).where(F.col("n_deleted") < F.col("n_lines"))
    changed = F.col("n_deleted") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return found.select(*[
        F.when(changed, new[c]).otherwise(F.col("row").getField(c)).alias(c) if c in new else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ])
