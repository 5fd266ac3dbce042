"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed byte trigrams of its lower-cased letters, weighted by
(1 + log tf) * idf and scaled to length one. ``train`` counts document frequencies over all
labelled rows and clusters a bounded sample of each language's vectors into ``centroids`` unit
vectors (spherical k-means). ``classify`` takes the centroid with the largest cosine; a text that
lies within the radius of no centroid of that language is rejected.

A cosine grows with the length of a text, so radii hold for a language and a band of length (powers
of two of the number of trigrams; bands with few texts are joined, and the shortest texts, when few,
are measured with those of all languages). The radius is a high quantile
(1 - ``odd``) of the labelled texts' distances to their nearest centroid, each sampled text left out
of its own centroid, plus a share (``slack``) of what is left to 1, so that texts like the labelled
ones stay; all labelled rows are measured. In a band only centroids that are nearest to a share
(``typical``) of its texts count: one made of short odd texts does not admit long ones. A text that
is null or has no letter is ``und`` with score 0 and is rejected. Ties go to the first language
in alphabetical order. Labelled rows without text, letter or language are not learned from; with
nothing to learn from every text is ``und``. All columns of ``docs`` are passed through; columns
that are named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

UNKNOWN = "und"
BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
TEXTS_AT_ONCE = 256
CHARS_AT_ONCE = 2 << 20
STEPS = 500  # of a cosine, when cosines are counted
BANDS = 9  # the last one holds all texts of 256 trigrams and more
_LETTER = regex.compile(r"\p{L}")  # as in ``train``: a digit in superscript is none
_LETTERS_ONLY = np.arange(256, dtype=np.uint8)
_LETTERS_ONLY[[i for i in range(128) if not chr(i).isalpha()]] = 32


@dataclass(frozen=True)
class Settings:
    """``sample_per_language`` bounds the rows that centroids are fitted on, by rate (not exactly)."""

    sample_per_language: int = 2000
    centroids: int = 4
    rounds: int = 12
    slack: float = 0.5
    odd: float = 0.01
    typical: float = 0.05
    texts_per_band: int = 20


@dataclass(frozen=True)
class Model:
    """Bounded by languages x centroids x buckets, whatever the input; ``radius`` has a column for each band, -1 where a centroid does not count."""

    languages: list[str]
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def portions(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are vectorised together: bounded in number and, but for one text, in size."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and (i - start == TEXTS_AT_ONCE or size + len(t) > CHARS_AT_ONCE):
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def counts(texts: list[str]) -> np.ndarray:
    """Trigram counts, one row for each text."""
    raw = [f" {t.lower()} ".encode() for t in texts]
    data = _LETTERS_ONLY[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(raw)), [len(x) for x in raw])
    wide = data.astype(np.uint32)
    code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    inside = (owner[2:] == owner[:-2]) & ((data[1:-1] != 32) | (data[2:] != 32) & (data[:-2] != 32))
    bucket = (code[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    cell = owner[:-2][inside] * BUCKETS + bucket
    return np.bincount(cell, minlength=len(raw) * BUCKETS).reshape(len(raw), BUCKETS)


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and each text's band of length."""
    tf = counts(texts)
    band = np.minimum(np.log2(np.maximum(tf.sum(axis=1), 1)).astype(int), BANDS - 1)
    v = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), np.float32(1e-12)), band


def _joined(per_band: np.ndarray, least: int) -> tuple[int, list[tuple[int, int]]]:
    """Ranges of bands with ``least`` texts each, the longest texts first, and where the shortest range begins."""
    ranges, end = [], BANDS
    for start in reversed(range(BANDS)):
        if per_band[start:end].sum() >= least:
            ranges.append((start, end))
            end = start
    return end, ranges


def _typical(nearest: np.ndarray, band: np.ndarray, k: int, settings: Settings) -> np.ndarray:
    """For each centroid and band: whether it is nearest to enough of the band's texts."""
    typical = np.ones((k, BANDS), dtype=bool)
    for start, end in _joined(np.bincount(band, minlength=BANDS), settings.texts_per_band)[1]:
        share = np.bincount(nearest[(band >= start) & (band < end)], minlength=k)
        typical[:, start:end] = (share >= settings.typical * share.sum())[:, None]
    return typical


def _fit(table: pa.Table, settings: Settings, idf: np.ndarray) -> pa.Table:
    """Spherical k-means over the sampled texts of one language."""
    texts = sorted(table["text"].to_pylist())
    v, band = map(np.concatenate, zip(*[vectors(texts[a:b], idf) for a, b in portions(texts)]))
    mean = v.sum(axis=0)
    by_likeness = np.argsort(v @ (mean / max(np.linalg.norm(mean), 1e-12)), kind="stable")
    k = min(settings.centroids, len(v))
    centers = v[by_likeness[(2 * np.arange(k) + 1) * len(v) // (2 * k)]]  # from odd to typical texts
    for _ in range(settings.rounds):
        nearest = (v @ centers.T).argmax(axis=1)
        for k in range(len(centers)):
            if (own := v[nearest == k]).size:
                total = own.sum(axis=0)
                centers[k] = total / max(np.linalg.norm(total), 1e-12)
    own = [v[nearest == k].sum(axis=0) for k in range(len(centers))]
    rows = len(centers)
    return pa.table({
        "lang": pa.array([table["lang"][0].as_py()] * rows, pa.string()), "length": pa.array([float(np.linalg.norm(x)) for x in own], pa.float64()),
        "typical": pa.array(_typical(nearest, band, rows, settings).tolist(), pa.list_(pa.bool_())),
        "center": pa.array([c.astype(np.float32).tobytes() for c in centers], pa.binary()),
    })


def _cosines(rows: DataFrame, languages: list[str], centers: np.ndarray, length: np.ndarray, typical: np.ndarray, idf: np.ndarray) -> DataFrame:
    """(lang, band, step, n): how many texts have which cosine with the nearest typical centroid of their language.

    ``rows`` has text, lang and whether the text was sampled; a sampled one is taken out of the
    centroid it is nearest to, which is a sum of texts of the given length.
    """
    of = {lang: np.flatnonzero(np.array(languages) == lang) for lang in languages}
    order = list(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(order), BANDS, STEPS + 1), dtype=np.int64)
        for batch in batches:
            texts, langs, sampled = (c.to_pylist() for c in batch.columns)
            at = [i for i, t in enumerate(texts) if has_letter(t) and langs[i] in of]
            for a, b in portions([texts[i] for i in at]):
                v, band = vectors([texts[i] for i in at[a:b]], idf)
                for x, similar, i in zip(band, (v @ centers.T).astype(np.float64), at[a:b]):
                    own = of[langs[i]]
                    if sampled[i]:
                        k = own[similar[own].argmax()]
                        rest = length[k] ** 2 - 2 * length[k] * similar[k] + 1
                        similar[k] = (length[k] * similar[k] - 1) / np.sqrt(rest) if rest > 1e-6 else 0
                    best = similar[own[typical[own, x]]].max()
                    total[order.index(langs[i]), x, int(np.clip(best, 0, 1) * STEPS)] += 1
        lang, band, step = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([order[k] for k in lang], pa.string()), pa.array(band, pa.int32()), pa.array(step, pa.int32()), pa.array(total[lang, band, step], pa.int64())],
            names=["lang", "band", "step", "n"],
        )

    return rows.mapInArrow(run, "lang string, band int, step int, n long").groupBy("lang", "band", "step").agg(F.sum("n").alias("n"))


def _radii(counted: np.ndarray, everyone: np.ndarray, settings: Settings) -> np.ndarray:
    """A language's radius for each band, from texts counted by band and step of the cosine: its own and those of all languages."""

    def least(per_step: np.ndarray) -> float:
        upto = per_step.cumsum()
        return np.searchsorted(upto, settings.odd * upto[-1], side="right") / STEPS if upto[-1] else 1.0

    cosine = np.ones(BANDS)
    few, ranges = _joined(counted.sum(axis=1), settings.texts_per_band)
    for start, end in ranges:
        cosine[start:end] = least(counted[start:end].sum(axis=0))
    if few:
        cosine[:few] = min(cosine[few:].min(initial=1.0), least(counted[:few].sum(axis=0)), least(everyone[:few].sum(axis=0)))
    return 1 - (1 - settings.slack) * cosine


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS + 1, dtype=np.int64)  # the last one counts texts
    for batch in batches:
        texts = [t for t in batch.column(0).to_pylist() if has_letter(t)]
        for a, b in portions(texts):
            part = counts(texts[a:b])
            total[:-1] += (part > 0).sum(axis=0)
            total[-1] += len(part)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1), pa.int32()), pa.array(total, pa.int64())], names=["bucket", "n"])


def train(labelled: DataFrame, settings: Settings = Settings(), text_column: str = "text", lang_column: str = "lang") -> Model:
    """A model from the rows that have a text and a language."""
    rows = labelled.select(F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    seen = rows.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(BUCKETS + 1)
    for r in seen:
        total[r["bucket"]] = r["n"]
    idf = (np.log((1 + total[-1]) / (1 + total[:-1])) + 1).astype(np.float32)
    per_language = rows.groupBy("lang").count().collect()
    rate = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1.0, settings.sample_per_language / r["count"]))) for r in per_language], F.lit(0.0))
    rows = rows.withColumn("sampled", F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < rate * (1 << 30))
    fitted = rows.where("sampled").select("text", "lang").groupBy("lang").applyInArrow(lambda t: _fit(t, settings, idf), "lang string, length double, typical array<boolean>, center binary")
    found = sorted(fitted.collect(), key=lambda r: (r["lang"], r["center"]))
    if not found:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros((0, BANDS)), idf)
    languages, centers = [r["lang"] for r in found], np.stack([np.frombuffer(r["center"], dtype=np.float32) for r in found])
    typical = np.array([r["typical"] for r in found])
    counted = {lang: np.zeros((BANDS, STEPS + 1), dtype=np.int64) for lang in languages}
    for r in _cosines(rows.select("text", "lang", "sampled"), languages, centers, np.array([r["length"] for r in found]), typical, idf).collect():
        counted[r["lang"]][r["band"], r["step"]] = r["n"]
    everyone = sum(counted.values())
    radii = {lang: _radii(c, everyone, settings) for lang, c in counted.items()}
    return Model(languages, centers, np.where(typical, np.stack([radii[lang] for lang in languages]), -1.0), idf)


def _predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
    at = [i for i, t in enumerate(texts) if has_letter(t)] if model.languages else []
    languages = np.array(model.languages)
    for a, b in portions([texts[i] for i in at]):
        own = at[a:b]
        v, band = vectors([texts[i] for i in own], model.idf)
        similar = v @ model.centroids.T
        best = similar.argmax(axis=1)
        value = similar[np.arange(len(own)), best]
        near = (1 - similar <= model.radius[:, band].T) & (languages == languages[best][:, None])
        score[own], rejected[own] = np.clip(value, 0, 1), ~near.any(axis=1)
        for i, k in zip(own, best):
            lang[i] = model.languages[k]
    return lang, score, rejected


def classify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    docs = docs.select(*kept)
    at = kept.index(text_column)
    schema = to_arrow_schema(docs.schema)
    for name, kind in (("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())):
        schema = schema.append(pa.field(name, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rejected = _predict(model, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=schema.names)

    return docs.mapInArrow(run, from_arrow_schema(schema))


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with exactly their columns."""
    at, names = docs.columns.index(text_column), to_arrow_schema(docs.schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, rejected = _predict(model, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(~rejected)).columns, names=names)

    return docs.mapInArrow(run, docs.schema)
