"""Language identification by bit-sliced Bloom filters of character n-grams.

Each language has a Bloom filter of its characteristic n-grams. The filters are bit-sliced: slot s holds one word with a
bit for each language, so ANDing the slots of an n-gram's hashes gives at once the bitmask of all languages that contain
it. A text's popcount for each language over its n-grams, corrected for that filter's false-positive rate, decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.llm import common

GRAM = 4
#: Bounds of the fit: about so many training documents and at most so many n-grams for each language.
SAMPLE_PER_LANGUAGE = 1500
GRAMS_PER_LANGUAGE = 30_000
#: An n-gram belongs to a language that uses it at least this often relative to the language that uses it most.
SHARE = 0.5
SLOTS = 1 << 20
HASHES = 2
_P = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32
_CHUNK = 1 << 20
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters than letters made one space, with spaces around."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[raw]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    body = np.where(letter, raw, np.uint32(_SPACE))[keep]
    lead = [] if len(body) and body[0] == _SPACE else [_SPACE]
    return np.concatenate([np.array(lead, np.uint32), body, np.array([_SPACE, _SPACE], np.uint32)])


def grams(codes: np.ndarray, n: int = GRAM) -> np.ndarray:
    """A mixed 64-bit hash of every n-gram."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64)
    h = c[: len(c) - n + 1].copy()
    for i in range(1, n):
        h *= np.uint64(0x100000001B3)
        h += c[i : len(c) - n + 1 + i]
    h *= _P
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Model:
    """languages: sorted names; filters: (words, slots) of language bits; fpr: a false-positive rate for each language."""

    languages: list[str]
    filters: np.ndarray
    fpr: np.ndarray
    fallback: int

    @staticmethod
    def build(languages: list[str], members: list[np.ndarray], fallback: int, slots: int = SLOTS, hashes: int = HASHES) -> Model:
        width = np.dtype(np.uint8 if len(languages) <= 8 else np.uint64)
        per = width.itemsize * 8
        filters = np.zeros((max(1, -(-len(languages) // per)), slots), width)
        fpr = np.zeros(len(languages))
        for i, own in enumerate(members):
            bit = width.type(1 << (i % per))
            for k in range(hashes):
                np.bitwise_or.at(filters[i // per], Model.slot(own, k, slots), bit)
            fpr[i] = float(((filters[i // per] & bit) != 0).mean()) ** hashes
        return Model(languages, filters, fpr, fallback)

    @staticmethod
    def slot(h: np.ndarray, k: int, slots: int) -> np.ndarray:
        return ((h >> np.uint64(22 * k)) & np.uint64(slots - 1)).astype(np.int64)

    def counts(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(texts, languages): popcounts between the starts (strictly increasing, each below len(hashes))."""
        out = np.zeros((len(starts), len(self.languages)), np.int64)
        per = self.filters.dtype.itemsize * 8
        for w, words in enumerate(self.filters):
            mask = words[self.slot(hashes, 0, words.size)]
            for k in range(1, HASHES):
                mask = mask & words[self.slot(hashes, k, words.size)]
            for i in range(w * per, min(len(self.languages), (w + 1) * per)):
                bits = (mask >> mask.dtype.type(i - w * per)) & mask.dtype.type(1)
                out[:, i] = np.add.reduceat(bits, starts, dtype=np.int64)
        return out

    def decide(self, counts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, score and coverage of each text from its popcounts and its number of n-grams."""
        real = np.clip((counts - n[:, None] * self.fpr) / np.maximum(1 - self.fpr, 1e-9), 0, None)
        best = real.argmax(axis=1)
        top = real[np.arange(len(n)), best]
        none = top <= 0
        best[none] = self.fallback
        total = real.sum(axis=1)
        return best, np.where(none, 0.0, top / np.where(none, 1, total)), np.clip(top / np.maximum(n, 1), 0, 1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """lang_pred, score and coverage for each text; long batches are worked off in chunks."""
        lang, score, cover = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        at, held, size = [], [], 0

        def flush() -> None:
            nonlocal at, held, size
            if not at:
                return
            n = np.array([len(h) for h in held])
            best, s, c = self.decide(self.counts(np.concatenate(held), np.r_[0, np.cumsum(n)[:-1]]), n)
            for j, i in enumerate(at):
                lang[i], score[i], cover[i] = self.languages[best[j]], s[j], c[j]
            at, held, size = [], [], 0

        for i, t in enumerate(texts):
            if not t or not has_letter(t) or not self.languages:
                continue
            h = grams(_codes(t))
            if not len(h):
                lang[i] = self.languages[self.fallback]
                continue
            at.append(i)
            held.append(h)
            size += len(h)
            if size > _CHUNK:
                flush()
        flush()
        return lang, score, cover


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fold that takes no part in training."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_per_language: int = SAMPLE_PER_LANGUAGE, grams_per_language: int = GRAMS_PER_LANGUAGE) -> Model:
    """Fit on a sample of about sample_per_language documents of each language (chosen by a hash of the id); whole texts.

    Rows with a null text or language teach nothing. Without any row the model knows no language and says ``und``.
    """
    rows = train.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("pick")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((1, 1), np.uint8), np.zeros(0), 0)
    names = sorted(sizes)
    index = {n: i for i, n in enumerate(names)}
    million = 1_000_000
    share = F.lit(million)
    for name in names:
        if sizes[name] > sample_per_language:
            share = F.when(F.col("lang") == name, max(1, million * sample_per_language // sizes[name])).otherwise(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches):
            by: dict[int, list[np.ndarray]] = {}
            for t, l in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(index[l], []).append(grams(_codes(t)))
            for i, held in by.items():
                g, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), i, np.int32)), pa.array(g.view(np.int64)), pa.array(n)], ["l", "g", "n"])

    sample = rows.where(F.pmod("pick", F.lit(million)) < share).select("text", "lang")
    counted = sample.mapInArrow(run, "l int, g long, n long").groupBy("g").agg(*(F.sum(F.when(F.col("l") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(names))))
    counted = common.materialise(counted, "langid")
    totals = counted.agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names)))).first()
    rate = [F.col(f"n{i}") / F.lit(float(totals[i] or 1)) for i in range(len(names))]
    top = F.greatest(*rate) if len(rate) > 1 else rate[0]
    members = []
    for i in range(len(names)):
        least = 2 if (totals[i] or 0) > 10_000 else 1
        chosen = counted.where((F.col(f"n{i}") >= least) & (rate[i] >= SHARE * top)).orderBy(F.desc(f"n{i}"), "g").limit(grams_per_language).select("g")
        members.append(chosen.toPandas()["g"].to_numpy(np.int64).view(np.uint64))
    return Model.build(names, members, index[max(names, key=lambda n: (sizes[n], n))])


NAMES = ("lang_pred", "score", "coverage")


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """The columns keep (default: all) of docs with lang_pred, score (0 to 1: the winner's share of all corrected
    popcounts) and coverage (its share of the text's n-grams), under the given names; columns of these names are replaced.

    Null texts and texts without a letter: ``und``, 0, 0. Texts of letters without any known n-gram: the most frequent
    training language with score 0. Repeated rows each get their row.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    plain = [f"c{i}" for i in range(len(keep))]  # Spark hands columns to Python by name, and finds none with a dot in it
    kept = [F.col(f"`{c}`").alias(p) for c, p in zip(keep, plain)]
    schema = docs.select(*kept, F.lit("").alias("l"), F.lit(0.0).alias("s"), F.lit(0.0).alias("v")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches):
            lang, score, cover = held.value.predict(b.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(lang, pa.string()), pa.array(score), pa.array(cover)], [*plain, "l", "s", "v"])

    return docs.select(*kept, F.col(f"`{text_col}`").alias("t")).mapInArrow(run, schema).toDF(*keep, *names)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, coverage): trained on all folds but the held-out one, predicted for every row.

    Repeated rows teach as often as they come and each get their row; null ids pass through, are not held out and teach
    nothing. An empty table gives no rows; other columns are ignored. Of equal counts the first language by name wins.
    """
    model = fit(docs.where(~F.coalesce(held_out(), F.lit(True))))
    rows = predict(docs, model, keep=["doc_id"])
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "coverage")


def accept(docs: DataFrame, least_coverage: float = 0.1) -> DataFrame:
    """The rows of docs in a recognised language: not ``und``, and at least least_coverage of the n-grams known.

    Null texts and texts without a letter go. Repeated rows are judged alike, all columns are kept, whatever their names, and
    an empty table stays empty.
    """
    names = tuple(common.fresh(docs.columns, "_heron_lang", "_heron_score", "_heron_coverage"))
    model = fit(docs.where(~F.coalesce(held_out(), F.lit(True))))
    return predict(docs, model, names=names).where((F.col(names[0]) != "und") & (F.col(names[2]) >= least_coverage)).select(*(F.col(f"`{c}`") for c in docs.columns))
