"""Language of a text by rank-order profiles of its n-grams.

A profile is the most frequent n-grams of one to three characters in order. A document's own
profile is compared with each language's: for every n-gram the places by which its ranks differ,
or the most there can be if the language lacks it. The language least out of place wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.batches import small_batches, with_columns
from tickloom.llm.sampling import sample_per_class

TOP = 400
DOCS_PER_LANGUAGE = 400
UNKNOWN = "und"
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of 1 to 3 characters inside words and over their edges, and how often each occurs.

    Letters are lower-cased and all else is one gap. An n-gram is three numbers of 21 bits.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(letters()[codes], codes, 0).astype(np.int64)
    codes = np.concatenate([[0], codes[(codes > 0) | (np.diff(codes, prepend=0) != 0)], [0]])
    a, b, c = codes, np.append(codes[1:], 0), np.append(codes[2:], [0, 0])[: len(codes)]
    one = a[a > 0]
    two = (a << 21 | b)[((a > 0) | (b > 0))]
    three = (a << 42 | b << 21 | c)[b > 0]
    # lengths are kept apart by the highest two bits
    return np.unique(np.concatenate([one, two | 1 << 61, three | 1 << 62]), return_counts=True)


def ranked(text: str | None, top: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties in the order of the n-grams."""
    grams, counts = gram_counts(text)
    return grams[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Ranks of n-grams in each language."""

    def __init__(self, ranks: dict[str, list[int]], top: int = TOP):
        self.languages, self.top = sorted(ranks), top
        self.grams = np.array(sorted({g for own in ranks.values() for g in own}), np.int64)
        self.rank = np.full((len(self.languages), len(self.grams) + 1), top, np.int64)
        for k, language in enumerate(self.languages):
            self.rank[k, np.searchsorted(self.grams, ranks[language])] = np.arange(len(ranks[language]))

    def identify(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 for a document with a language's own order, 0 if nothing agrees.

        Ties go to the language that sorts first.
        """
        own = ranked(text, self.top)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        known = at < len(self.grams)
        known[known] = self.grams[at[known]] == own[known]
        at[~known] = len(self.grams)
        places = np.abs(self.rank[:, at] - np.arange(len(own)))
        places[:, ~known] = self.top
        # an n-gram that one language has and another lacks counts in full against the latter
        places[self.rank[:, at] == self.top] = self.top
        distance = places.sum(axis=1)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (self.top * len(own))


def learn(docs: DataFrame, usable: Column, per_language: int = DOCS_PER_LANGUAGE, top: int = TOP) -> Profiles:
    """Profiles from a bounded sample: at most `per_language` documents of each lang value.

    `docs` has doc_id, text and lang; rows where `usable` does not hold and rows without lang or
    text are not looked at. n-grams are counted and ranked by Spark; `top` of each language reach
    the driver.
    """
    labelled = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = sample_per_class(labelled.select("doc_id", "lang"), "lang", "doc_id", per_language).select("doc_id").distinct()
    # at most `per_language` ids for each language
    texts = labelled.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id", "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, []).append(gram_counts(text))
            for lang, parts in found.items():
                grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

    counts = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("place", place).where(F.col("place") <= top).orderBy("lang", "place").collect()
    ranks: dict[str, list[int]] = {}
    for r in rows:
        ranks.setdefault(r.lang, []).append(r.gram)
    return Profiles(ranks, top)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Documents with lang_pred and score (0 to 1) for their whole texts.

    `und` with score 0 for a text that is null, empty or without a letter, and for all if no
    language was learned. Columns of these names give way.
    """
    known = docs.sparkSession.sparkContext.broadcast(profiles)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        found = [known.value.identify(t) for t in batch.column(0).to_pylist()]
        return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return with_columns(docs, "lang_pred string, score double", work, [text])
