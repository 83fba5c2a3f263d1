"""Language of texts by rank-order profiles.

A profile lists a language's most frequent n-grams of one to three characters, the most
frequent first. A document's list is compared with each profile: for each n-gram of the
document, how far its place is from the profile's; n-grams that the profile lacks count as
the length of the profile. The language with the smallest sum is predicted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from veilspark.llm.common import in_chunks, with_columns

PROFILE = 400
UNKNOWN = "und"
#: About so many labelled documents of each language are counted for its profile.
FIT_ROWS = 20_000
_OTHER = re.compile(r"[\W\d_]+")
_COUNTED = 1 << 16
_SHIFT = 21


def letters(text: str | None) -> str | None:
    """The text's words in lower case with one space around each; None if it has no letter."""
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {words} " if any(map(str.isalpha, words)) else None


def grams(words: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams (1 to 3) of a text as numbers, ascending, and their counts. Spaces alone don't count."""
    points = np.frombuffer(words.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for begin in range(0, len(points), _COUNTED):  # long texts in parts, so memory is bounded
        part = points[begin : begin + _COUNTED + 2]
        pairs = part[:-1] << _SHIFT | part[1:]
        triples = pairs[:-1] << _SHIFT | part[2:]
        own = min(_COUNTED, len(part))
        every = np.concatenate((part[:own], pairs[:own], triples[:own]))
        kinds, n = np.unique(every, return_counts=True)
        if begin:
            kinds, place = np.unique(np.concatenate((found, kinds)), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate((counts, n))).astype(np.int64)
        found, counts = kinds, n
    keep = found != 32
    return found[keep], counts[keep]


def ranked(found: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent n-grams, the most frequent first, ties by number."""
    if len(found) > 2 * size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        found, counts = found[keep], counts[keep]
    return found[np.lexsort((found, -counts))[:size]]


@dataclass(frozen=True)
class Profiles:
    """`grams`: all profiles' n-grams, ascending; `ranks`: their place in each profile, else `size`."""

    names: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, lists: dict[str, list[int]], size: int) -> Profiles:
        names = tuple(sorted(lists))
        union = np.array(sorted({gram for some in lists.values() for gram in some}), np.int64)
        ranks = np.full((len(union), len(names)), size, np.int64)
        for column, name in enumerate(names):
            ranks[np.searchsorted(union, lists[name]), column] = np.arange(len(lists[name]))
        return cls(names, union, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score: one less the mean distance over the profile's length."""
        words = letters(text)
        if words is None or not self.names:
            return UNKNOWN, 0.0
        own = ranked(*grams(words), self.size)
        place = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = np.where((self.grams[place] == own)[:, None], self.ranks[place], self.size)
        far = np.where(ranks < self.size, np.abs(ranks - np.arange(len(own))[:, None]), self.size)
        sums = far.sum(axis=0)
        best = int(np.argmin(sums))
        return self.names[best], float(1 - sums[best] / (self.size * len(own)))


def fit(labelled: DataFrame, size: int = PROFILE, fit_rows: int = FIT_ROWS) -> Profiles:
    """Profiles of each lang of `labelled` (doc_id, text, lang), all of whose rows may be used.

    Rows without text or lang are left out. Of a language with more than `fit_rows` rows, a
    share is drawn by the hash of doc_id that has about as many. A lang without letters in its
    texts has no profile. There are as many profiles as languages, each of bounded length.
    """
    known = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for lang, n in counts.items():
        if n > fit_rows:
            share = F.when(F.col("lang") == lang, fit_rows / n).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) < share * (1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for chunk in in_chunks(batches, "text"):
            for text, lang in zip(chunk.column("text").to_pylist(), chunk.column("lang").to_pylist()):
                if (words := letters(text)) is not None:
                    sums.setdefault(lang, []).append(grams(words))
                    if len(sums[lang]) >= 200:
                        sums[lang] = [_added(sums[lang])]
        for lang, parts in sums.items():
            found, n = _added(parts)
            columns = [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    counted = known.where(drawn).mapInArrow(count, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("place", F.row_number().over(order))
    lists: dict[str, list[int]] = {}
    for row in top.where(F.col("place") <= size).orderBy("lang", "place").collect():
        lists.setdefault(row["lang"], []).append(row["gram"])
    return Profiles.of(lists, size)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    kinds, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return kinds, np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def predict(docs: DataFrame, profiles: Profiles, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`docs` with lang_pred and score, or other `names`; only `text` is looked at, whole.

    A text that is null, empty or without letters is `und` with score 0, as is every text if
    nothing was learned. Of languages at the same distance the first by name is taken. All rows
    and columns stay; columns of the two names are replaced.
    """
    kept = docs.drop(*names)
    schema = with_columns(kept, **dict(zip(names, ("string", "double"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "text"):
            found = [profiles.predict(text) for text in chunk.column("text").to_pylist()]
            columns = [*chunk.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*chunk.schema.names, *names])

    return kept.mapInArrow(run, schema)


def with_letters(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose `text` has a letter, whatever was learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "text"):
            yield chunk.filter(pa.array([letters(text) is not None for text in chunk.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(docs: DataFrame) -> DataFrame:
    """`docs` with held_out: the CRC-32 of doc_id as text is divisible by 5. A null doc_id is held out."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return docs.withColumn("held_out", F.coalesce(remainder == 0, F.lit(True)))


def learn(docs: DataFrame, size: int = PROFILE, fit_rows: int = FIT_ROWS) -> Profiles:
    """Profiles from the rows of `docs` (doc_id, text, lang) that aren't held out."""
    return fit(held_out(docs).where(~F.col("held_out")), size, fit_rows)


def identify(docs: DataFrame, size: int = PROFILE, fit_rows: int = FIT_ROWS) -> DataFrame:
    """`docs` (doc_id, text, lang) with held_out, lang_pred and score, learned from the rest."""
    return predict(held_out(docs), learn(docs, size, fit_rows))
