"""Language ID by nearest centroid.

Texts become TF-IDF vectors of hashed letter n-grams (2 and 3 characters, lower case, other characters as one space), scaled
to length one. Spherical k-means gives each language several centroids, from a bounded sample of labelled rows; a text gets
the language of the centroid with the highest cosine. A text further from all centroids than any of the sample, by a margin
that depends on its length, is rejected, as is one without letters.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, prepare

#: Fitting takes at most SAMPLE rows in all and PER_LANGUAGE of a language.
SAMPLE, PER_LANGUAGE = 8000, 400
DIMS, CENTROIDS, ROUNDS, GRAMS = 4096, 4, 8, (2, 3)
#: A text is rejected below MARGIN times the least cosine of those in the sample that have FEW different n-grams or more. For
#: texts with fewer the bound shrinks in proportion, as a short text lies far from every centroid.
MARGIN, FEW = 0.5, 100
UNKNOWN = "und"
_RUN = 1 << 20
_fold = None


def letters() -> np.ndarray:
    """The lower-case letter of each code point, 0 where there is none."""
    global _fold
    if _fold is None:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if (x := chr(c)).isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold = table
    return _fold


def counts(texts: list[str | None], dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts of each text by hashed dimension, and whether it has a letter."""
    out, has = np.zeros((len(texts), dims), np.float32), np.zeros(len(texts), bool)
    k = 0
    while k < len(texts):
        first, size, some = k, 0, []
        while k < len(texts) and (not some or size < _RUN):
            some.append(texts[k] or "")
            size += len(some[-1])
            k += 1
        codes = np.frombuffer(" ".join(["", *some, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        of = np.repeat(np.arange(len(some) + 1), [1, *(len(t) + 1 for t in some)])  # the blank after a text is its own
        low = letters()[codes]
        stay = (low > 0) | np.concatenate(([True], low[:-1] > 0))  # runs of others become one space
        low, of = low[stay].astype(np.uint64), np.maximum(of[stay], 1) - 1
        has[first:k] |= np.bincount(of[low > 0], minlength=len(some)) > 0
        for n in GRAMS:
            m = len(low) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for x in range(n):
                h = h * np.uint64(0x100000001B3) + low[x : x + m]
            good = (of[:m] == of[n - 1 :]) & (low[1 : 1 + m] > 0 if n == 3 else (low[:m] > 0) | (low[1 : 1 + m] > 0))
            at = of[:m][good] * dims + (mix(h[good]) % np.uint64(dims)).astype(np.int64)
            out[first:k] += np.bincount(at, minlength=len(some) * dims).reshape(-1, dims)
    return out, has


class Model:
    """Centroids (rows of length one), the language of each, idf, and the least cosine that counts."""

    def __init__(self, names: list[str], centroids: np.ndarray, languages: np.ndarray, idf: np.ndarray, least: float) -> None:
        self.names, self.centroids, self.languages, self.idf, self.least = names, centroids, languages, idf, least

    def vectors(self, n: np.ndarray) -> np.ndarray:
        v = np.log1p(n) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each text."""
        n, has = counts(texts, len(self.idf))
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = self.vectors(n) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(np.round(cosine[np.arange(len(texts)), best].astype(float), 6), 0, 1)
        names = [self.names[self.languages[b]] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
        return names, np.where(has, score, 0.0), ~has | (score < self.least * np.minimum(1, (n > 0).sum(axis=1) / FEW))


def k_means(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from rows far from each other, so it has no random part."""
    at = [int(np.argmax(v @ v.mean(axis=0)))]
    while len(at) < min(k, len(v)):
        far = (v @ v[at].T).max(axis=1)
        at.append(int(far.argmin()))
    c = v[at]
    for _ in range(ROUNDS):
        own = (v @ c.T).argmax(axis=1)
        c = np.stack([v[own == x].sum(axis=0) if (own == x).any() else c[x] for x in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(texts: list[str], langs: list[str], dims: int = DIMS) -> Model:
    """A model from labelled texts; those without letters teach nothing. The result does not depend on their order."""
    order = sorted(range(len(texts)), key=lambda k: (langs[k], texts[k]))
    n, has = counts([texts[k] for k in order], dims)
    langs, n = np.array([langs[k] for k in order], dtype=object)[has], n[has]
    names = sorted(set(langs.tolist()))
    idf = np.log((1 + len(n)) / (1 + (n > 0).sum(axis=0))).astype(np.float32) + 1
    model = Model(names, np.zeros((0, dims), np.float32), np.zeros(0, np.int64), idf, 0.0)
    if not names:
        return model
    v = model.vectors(n)
    groups = [k_means(v[langs == x], CENTROIDS) for x in names]
    model.centroids, model.languages = np.concatenate(groups), np.repeat(np.arange(len(names)), [len(g) for g in groups])
    own = (v @ model.centroids.T).max(axis=1)
    long = (n > 0).sum(axis=1) >= FEW
    model.least = float(MARGIN * own[long].min()) if long.any() else 0.0
    return model


def fitted(docs: DataFrame, learn, sample: int = SAMPLE, per_language: int = PER_LANGUAGE) -> Model:
    """A model from the rows where learn holds and lang isn't null: of each language those of least hash, within the bounds."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn).select("lang", "text", F.xxhash64("doc_id").alias("h"))
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()}
    if not sizes:
        return fit([], [])
    share = min(per_language, max(1, sample // len(sizes)))
    steps = 1 << 20
    bound = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(steps, 2 * steps * share // n + 1))])
    near = labelled.where(F.pmod(F.col("h"), F.lit(steps)) < bound[F.col("lang")])  # about twice the share of each
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = near.withColumn("k", order).where(F.col("k") <= share).select("lang", "text").collect()
    return fit([r.text for r in rows], [r.lang for r in rows])


def training_rows():
    """The contract's learning rows: the CRC-32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.lit(False))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, lang_score and lang_rejected after its columns, by whole texts.

    A null text and one without letters are `und`, score 0, rejected; so is every text if nothing was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, lang_score double, lang_rejected boolean")
    def run(texts: pa.Array) -> pa.Array:
        out = [shared.value.predict(texts.slice(k, 256).to_pylist()) for k in range(0, len(texts), 256)]
        parts = [x for o in out for x in o[0]], np.concatenate([o[1] for o in out] or [np.zeros(0)]), np.concatenate([o[2] for o in out] or [np.zeros(0, bool)])
        return pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(parts, (pa.string(), pa.float64(), pa.bool_()), strict=True)], names=["lang_pred", "lang_score", "lang_rejected"])

    return docs.withColumn("_lang", run(F.col(text_col))).select(*docs.columns, "_lang.lang_pred", "_lang.lang_score", "_lang.lang_rejected")


def language_id(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, held_out, lang_pred, score, rejected. Learns from rows that aren't held out."""
    prepare(docs.sparkSession)
    model = fitted(docs, training_rows())
    few = docs.select("doc_id", "text")
    return identify(few, model).select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def accepted(docs: DataFrame) -> DataFrame:
    """docs without those that the classifier, fitted on their own labels, rejects."""
    prepare(docs.sparkSession)
    return identify(docs, fitted(docs, F.lit(True))).where("not lang_rejected").select(*docs.columns)

