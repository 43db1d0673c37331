"""Language by rank-order profiles.

A profile is a language's most frequent letter n-grams (one to three letters, word ends count as a sign) in order of
frequency. A document's own most frequent n-grams are compared to each profile by out-of-place distance: the sum of
rank differences, the profile length for an n-gram that the profile lacks. Counts cover all learning documents and
are summed per task before the shuffle; only the profiles (languages x `size` rows) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foretide.llm.common import in_steps

SIZE = 400
UNKNOWN = "und"
_POINT = 21  # bits of a code point
_EDGE = 1  # stands for a word's end in n-gram codes


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def count_grams(texts: list[str], group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram code, count) of all letter n-grams, sorted by group and then by n-gram."""
    none = np.zeros(0, np.int64)
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered])
    points = np.frombuffer(("\n".join([*lowered, ""])).encode("utf-32-le"), np.uint32)
    letter = _letters()[points]
    keep = letter | np.r_[True, letter[:-1]]
    points, letter, owner = points[keep], letter[keep], np.repeat(group, sizes)[keep]
    if not letter.any():
        return none, none, none
    seen = np.zeros(0x110000, bool)
    seen[points[letter]] = True
    alphabet = np.r_[_EDGE, np.flatnonzero(seen)].astype(np.int64)
    many = len(alphabet)
    total = many + many**2 + many**3
    if int(owner.max()) + 1 >= 2**62 // total:  # does not fit one key: by halves
        if len(texts) == 1:
            _, grams, counts = count_grams(texts, np.zeros(1, np.int64))
            return np.full(len(grams), group[0]), grams, counts
        half = len(texts) // 2
        parts = [count_grams(texts[:half], group[:half]), count_grams(texts[half:], group[half:])]
        return add_counts([p for p in parts if len(p[0])])
    dense = np.zeros(0x110000, np.int32)
    dense[alphabet[1:]] = np.arange(1, many)
    # An edge at either end of the whole; every kept non-letter is one edge.
    x = np.r_[0, np.where(letter, dense[points], 0)].astype(np.int64)
    at = np.flatnonzero(letter) + 1
    own, left, mid, right = owner[at - 1].astype(np.int64) * total, x[at - 1], x[at], x[at + 1]
    ends = right == 0
    keys = np.concatenate([
        own + mid,
        own + many + left * many + mid,
        own[ends] + many + mid[ends] * many,
        own + many + many**2 + (left * many + mid) * many + right,
    ])
    keys.sort()
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts, keys = np.diff(np.r_[starts, len(keys)]), keys[starts]
    who, gram = np.divmod(keys, total)
    one, two = gram < many, (gram >= many) & (gram < many + many**2)
    code = np.empty(len(gram), np.int64)
    code[one] = alphabet[gram[one]]
    pair = gram[two] - many
    code[two] = alphabet[pair // many] << _POINT | alphabet[pair % many]
    three = ~one & ~two
    triple = gram[three] - many - many**2
    code[three] = (
        alphabet[triple // many**2] << 2 * _POINT | alphabet[triple // many % many] << _POINT | alphabet[triple % many]
    )
    return who, code, counts


def add_counts(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One (group, n-gram, count) list out of several."""
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    who, code, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((code, who))
    who, code, counts = who[order], code[order], counts[order]
    starts = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (code[1:] != code[:-1])]) if len(who) else who
    return who[starts], code[starts], np.add.reduceat(counts, starts) if len(who) else counts


def fit(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(lang, rank, gram) profiles from (text, lang) rows; rows without text or lang teach nothing.

    Repeated rows count as often as they stand there; columns of other names do not matter; an empty table, or one
    without a letter, gives no profile.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        parts, held = [], 0
        for step in in_steps(batches):
            langs = [names.setdefault(v, len(names)) for v in step.column("lang").to_pylist()]
            parts.append(count_grams(step.column("text").to_pylist(), np.array(langs)))
            held += len(parts[-1][0])
            if held > 500_000:
                parts = [add_counts(parts)]
                held = -len(parts[0][0])  # merge again once as much has come in anew
        who, code, counts = add_counts(parts)
        if len(who):
            lang = pa.DictionaryArray.from_arrays(pa.array(who, pa.int32()), pa.array(list(names))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang, pa.array(code), pa.array(counts)], ["lang", "gram", "n"])

    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counted = known.dropna().mapInArrow(run, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order) - 1)
    return ranked.where(F.col("rank") < size).select("lang", "rank", "gram")


def classify(docs: DataFrame, profiles: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, lang_pred, score): nearest profile, and 1 - distance / greatest possible distance.

    Null text, text without a letter, and any text when there are no profiles give `und` with score 0. Equal
    distances go to the name that sorts first. Repeated rows each give a row; a null doc_id stays null; an empty table
    gives no row; columns of other names do not matter.
    """
    rows = profiles.collect()  # languages x size
    langs = sorted({r.lang for r in rows})
    grams = np.array(sorted({r.gram for r in rows}), np.int64)
    place = np.full((len(langs), len(grams) + 1), size, np.int32)  # the last column: in no profile
    for r in rows:
        place[langs.index(r.lang), np.searchsorted(grams, r.gram)] = r.rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches):
            n = step.num_rows
            texts = [t or "" for t in step.column("text").to_pylist()]
            best, score = np.full(n, -1), np.zeros(n)
            who, code, counts = count_grams(texts, np.arange(n))
            if len(who) and langs:
                order = np.lexsort((np.arange(len(who)), -counts, who)) if len(who) * n * int(counts.max()) >= 2**62 else (
                    np.sort((who * (counts.max() + 1) + counts.max() - counts) * len(who) + np.arange(len(who))) % len(who)
                )
                who, code = who[order], code[order]
                rank = np.arange(len(who)) - np.searchsorted(who, who)
                top = rank < size
                who, code, rank = who[top], code[top], rank[top]
                at = np.searchsorted(grams, code)
                at = np.where(grams[np.minimum(at, len(grams) - 1)] == code, at, len(grams))
                lacks = place[:, at]
                apart = np.where(lacks == size, size, np.abs(lacks - rank))
                distance = np.stack([np.bincount(who, a, n) for a in apart])
                used = np.bincount(who, minlength=n)
                best = np.where(used > 0, distance.argmin(0), -1)
                score = np.where(used > 0, 1 - distance.min(0) / np.maximum(used * size, 1), 0.0)
            names = pa.array([langs[b] if b >= 0 else UNKNOWN for b in best], pa.string())
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), names, pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")
