"""Embeddings: providers, generation, the vector table as an index, and exact top-k search."""

import hashlib
import re
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import norm, unit

#: Characters that a model's provider takes of a text, and texts of one call.
MAX_TEXT, BATCH = 8192, 32


class Provider(Protocol):
    """What turns texts into vectors. Providers are pickled to the executors; heavy state belongs into load().

    max_text: characters of a text that the model takes, or None where it takes any."""

    name: str
    dimension: int
    max_text: int | None

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingProvider:
    """Deterministic vectors without a model: signed hashes of words of whole texts, scaled to length one."""

    max_text = None

    def __init__(self, dimension: int = 384) -> None:
        self.name, self.dimension = f"hashing-{dimension}", dimension

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for k, t in enumerate(texts):
            for w in re.findall(r"\w+", t.lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[k, h % self.dimension] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class LocalModelProvider:
    """A sentence-transformers model, loaded once per worker; that library is optional."""

    max_text = MAX_TEXT

    def __init__(self, name: str = "all-MiniLM-L6-v2", device: str = "cpu", dimension: int = 384) -> None:
        self.name, self.device, self.dimension = name, device, dimension

    def encode(self, texts: list[str]) -> np.ndarray:
        from sentence_transformers import SentenceTransformer

        if not hasattr(self, "_model"):
            self._model = SentenceTransformer(self.name, device=self.device)
        return self._model.encode(texts, batch_size=BATCH, normalize_embeddings=True)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_model"}


class RemoteProvider:
    """An HTTP embeddings endpoint that takes {"model", "input"} and answers {"data": [{"embedding"}]}."""

    max_text = MAX_TEXT
    DIMENSIONS = {"text-embedding-3-small": 1536, "text-embedding-3-large": 3072, "text-embedding-ada-002": 1536}

    def __init__(self, name: str = "text-embedding-3-small", url: str = "", key: str = "", timeout: float = 30, retries: int = 3) -> None:
        self.name, self.url, self.key, self.timeout, self.retries = name, url, key, timeout, retries
        self.dimension = self.DIMENSIONS.get(name, 1536)

    def encode(self, texts: list[str]) -> np.ndarray:
        import json
        import time
        import urllib.request

        out = []
        for k in range(0, len(texts), BATCH):
            body = json.dumps({"model": self.name, "input": texts[k : k + BATCH]}).encode()
            request = urllib.request.Request(self.url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
            for attempt in range(self.retries + 1):
                try:
                    with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                        out += [d["embedding"] for d in json.load(answer)["data"]]
                    break
                except OSError:
                    if attempt == self.retries:
                        raise
                    time.sleep(2**attempt)
        return np.array(out, np.float32)


def provider(kind: str, **options) -> Provider:
    known = {"hashing": HashingProvider, "local": LocalModelProvider, "remote": RemoteProvider}
    if kind not in known:
        raise ValueError(f"unknown provider {kind!r}; known: {', '.join(known)}")
    return known[kind](**options)


def working(first: Provider, fallback: Provider | None) -> Provider:
    """The first provider if it can encode a word here, else the fallback; decided before the job, so all rows use one model."""
    try:
        first.encode(["probe"])
    except Exception:
        if fallback is None:
            raise
        return fallback
    return first


def generate(rows: DataFrame, artifact: str, model: Provider, text_col: str = "text", version: str | None = None) -> DataFrame:
    """Vectors of rows ({artifact}_id, text): artifact_id, artifact_type, embedding, model_name, model_version. Texts are cut only at the model's max_text."""

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(model.encode([(t or "")[: model.max_text] for t in texts]), np.float32)))

    return rows.select(F.col(f"{artifact}_id").alias("artifact_id"), F.lit(artifact).alias("artifact_type"), encode(text_col).alias("embedding"), F.lit(model.name).alias("model_name"), F.lit(version).cast("string").alias("model_version"))


def with_wide_vector(df: DataFrame) -> DataFrame:
    """df with its vectors in `embedding`, whether they come so, as `vector`, `embedding_vector`, or one column per dimension."""
    for c in ("embedding", "vector", "embedding_vector"):
        if c in df.columns:
            return df.withColumnRenamed(c, "embedding")
    wide = sorted((c for c in df.columns if re.fullmatch(r"embedding_\d+", c)), key=lambda c: int(c[10:]))
    if not wide:
        raise ValueError("no vector column")
    return df.withColumn("embedding", F.array(*[F.col(c).cast("float") for c in wide])).drop(*wide)


def statistics(embeddings: DataFrame) -> DataFrame:
    return embeddings.groupBy("artifact_type").agg(F.count(F.lit(1)).alias("count"), F.first(F.size("embedding")).alias("dimension"), F.first("model_name").alias("model_name"))


def build_index(embeddings: DataFrame, metric: str = "l2") -> DataFrame:
    """The searchable vector table: artifact_id, embedding (length one for cosine), metric."""
    if metric not in ("l2", "ip", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    return embeddings.where(F.col("embedding").isNotNull()).select("artifact_id", (unit(F.col("embedding")) if metric == "cosine" else F.col("embedding")).alias("embedding"), F.lit(metric).alias("metric"))


def append_index(index: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Rows for the index of ids that it doesn't have, once each."""
    metric = index.select("metric").first()
    new = embeddings.join(index.select("artifact_id"), "artifact_id", "left_anti").dropDuplicates(["artifact_id"])
    return build_index(new, metric[0] if metric else "l2")


def growth(index: DataFrame, embeddings: DataFrame, limit: float = 0.3) -> tuple[int, float, bool]:
    """New ids, their ratio to those indexed, and whether that asks for a rebuild."""
    new = embeddings.select("artifact_id").distinct().join(index.select("artifact_id"), "artifact_id", "left_anti").count()
    old = index.count()
    share = new / old if old else float("inf" if new else 0)
    return new, share, share > limit


#: Queries are shared with every task; more than so many bytes of them are searched in further passes.
QUERY_BYTES = 64 << 20
#: Queries and corpus rows that are multiplied at once, and tasks of a pass at most, as each returns k rows for every query.
BLOCK, TASKS = (1024, 2048), 64


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Arrays of numbers, none of them null, as rows."""
    sizes = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(sizes) > 1:
        raise ValueError(f"vectors of {' and '.join(map(str, sorted(sizes)))} dimensions")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def top_k(queries: DataFrame, corpus: DataFrame, k: int = 10, metric: str = "cosine", exclude_self: bool = True, id_col: str = "artifact_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest of each query: query_id, neighbor_id, score, rank (from 1), exactly.

    Each task multiplies blocks of its part of the corpus with blocks of the queries and keeps the k nearest of each query so
    far; the tasks' rows are ranked by window. Scores are rounded to 6 places, so that ties go by neighbor_id whatever the
    order of summation. score: cosine or inner product, the greater the nearer; for l2 the squared distance, the smaller the
    nearer. A task holds one pass of queries (their bytes are checked and split into passes), k places for each, and one
    block of scores, whatever the number of queries; corpus rows only stream through. All pairs are compared."""
    spark = queries.sparkSession
    got = queries.select(id_col, vec_col).where(F.col(vec_col).isNotNull()).toArrow().combine_chunks()
    kind = dict(corpus.dtypes)[id_col]
    schema = f"query_id {kind}, neighbor_id {kind}, score double"
    if not got.num_rows:
        return spark.createDataFrame([], schema + ", rank int")
    ids, matrix = (pa.concat_arrays(got[c].chunks) for c in (id_col, vec_col))
    matrix = _matrix(matrix)
    per_pass = max(1, QUERY_BYTES // (8 * max(1, matrix.shape[1])))
    out = None
    for at in range(0, len(ids), per_pass):
        part = _pass(corpus.select(id_col, vec_col), ids[at : at + per_pass], matrix[at : at + per_pass], k, metric, exclude_self, schema)
        out = part if out is None else out.unionByName(part)
    order = F.col("score") if metric == "l2" else F.desc("score")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "neighbor_id"))).where(F.col("rank") <= k)


class _Nearest:
    """The k nearest of each query so far: sign (the smaller the nearer) and id, ties by id."""

    def __init__(self, n: int, k: int, kind: np.dtype) -> None:
        self.k, self.sign, self.id = k, np.full((n, k), np.inf), np.zeros((n, k), kind)

    def take(self, first: int, sign: np.ndarray, near: np.ndarray, rounded) -> None:
        """Scores of the queries from first on against the rows near. rounded: from signs to those that are ranked."""
        if not sign.size:
            return
        last = self.sign[first : first + len(sign), -1]
        if not np.isfinite(last).all():
            least = np.partition(sign, min(self.k, sign.shape[1]) - 1, axis=1)[:, min(self.k, sign.shape[1]) - 1]
            last = np.minimum(last, np.where(np.isnan(least), np.inf, least))
        row, col = np.nonzero(sign <= last[:, None] + 2e-6)  # more than rounding moves a score
        found = rounded(sign[row, col])
        row, col, found = row[np.isfinite(found)], col[np.isfinite(found)], found[np.isfinite(found)]
        if not len(row):
            return
        own = np.unique(row)
        kept = self.sign[first + own]
        x, y = np.nonzero(np.isfinite(kept))
        row, found, ids = np.concatenate([row, own[x]]), np.concatenate([found, kept[x, y]]), np.concatenate([near[col], self.id[first + own[x], y]])
        order = np.lexsort((np.unique(ids, return_inverse=True)[1], found, row))
        row, found, ids = row[order], found[order], ids[order]
        at = np.arange(len(row)) - np.searchsorted(row, row)
        row, found, ids, at = (v[at < self.k] for v in (row, found, ids, at))
        self.sign[first + own] = np.inf
        self.sign[first + row, at], self.id[first + row, at] = found, ids


def _pass(corpus: DataFrame, ids: pa.Array, matrix: np.ndarray, k: int, metric: str, exclude_self: bool, schema: str) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast((ids, matrix))

    def scan(batches):
        names, q = shared.value
        own: dict = {}
        for x, n in enumerate(names.to_pylist() if exclude_self else ()):
            own.setdefault(n, []).append(x)
        qn, qq = np.linalg.norm(q, axis=1) + 1e-8, (q**2).sum(axis=1)
        best = None
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(1)))
            for at in range(0, batch.num_rows, BLOCK[1]):
                part = batch.slice(at, BLOCK[1])
                c, near = _matrix(part.column(1)), part.column(0).to_numpy(zero_copy_only=False)
                if c.shape[1] != q.shape[1]:
                    raise ValueError(f"vectors of {c.shape[1]} and {q.shape[1]} dimensions")
                best = best or _Nearest(len(q), k, near.dtype)
                cn, cc = np.linalg.norm(c, axis=1) + 1e-8, (c**2).sum(axis=1)
                hits = [(x, y) for y, n in enumerate(near.tolist()) for x in own.get(n, ())]
                hits = np.array(hits, np.int64).reshape(-1, 2)
                for first in range(0, len(q), BLOCK[0]):
                    some = slice(first, min(first + BLOCK[0], len(q)))
                    sign = q[some] @ c.T
                    if metric == "l2":
                        sign *= -2
                        sign += qq[some, None] + cc
                    else:
                        if metric == "cosine":
                            sign /= qn[some, None] * cn
                        np.negative(sign, out=sign)
                    x, y = hits[(hits[:, 0] >= first) & (hits[:, 0] < some.stop)].T
                    sign[x - first, y] = np.inf
                    best.take(first, sign, near, lambda v: np.round(v, 6) + 0.0)
        for first in range(0, len(q) if best else 0, BLOCK[1]):
            sign = best.sign[first : first + BLOCK[1]]
            row, col = np.nonzero(np.isfinite(sign))
            score = sign[row, col] if metric == "l2" else 0.0 - sign[row, col]
            yield pa.RecordBatch.from_pydict({"query_id": names.take(pa.array(first + row)), "neighbor_id": pa.array(best.id[first + row, col], names.type), "score": score})

    return corpus.coalesce(TASKS).mapInArrow(scan, schema)


def lsh_index(embeddings: DataFrame, bucket: float = 2.0, tables: int = 4, seed: int = 42):
    """An approximate index (random projections): the fitted model and the vectors as ML vectors."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    rows = embeddings.select("artifact_id", array_to_vector("embedding").alias("v"))
    return BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=seed).fit(rows), rows


def clusters(embeddings: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """k-means clusters of vectors: embeddings with `cluster`."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = embeddings.withColumn("_v", array_to_vector("embedding"))
    return KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(rows).transform(rows).drop("_v")


def vector_summary(embeddings: DataFrame) -> DataFrame:
    """Mean, deviation, least and greatest component of each vector, and its norm."""
    n = F.size("embedding")
    mean = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")) / n
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / n
    return embeddings.select("artifact_id", mean.alias("mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("std"), F.array_min("embedding").alias("min"), F.array_max("embedding").alias("max"), norm(F.col("embedding")).alias("norm"))


def keyword_counts(beats: DataFrame, words: list[str]) -> DataFrame:
    """How many rows contain each keyword, in lower case."""
    one = beats.agg(*[F.count_if(F.contains(F.lower("text"), F.lit(w.lower()))).alias(w) for w in words])
    return one.unpivot([], words, "keyword", "count")


def subset(embeddings: DataFrame, ids: DataFrame) -> DataFrame:
    """The vectors of some artifacts; ids has artifact_id."""
    return embeddings.join(ids.select("artifact_id").distinct(), "artifact_id", "left_semi")


def search(text: str, corpus: DataFrame, model: Provider, k: int = 3, metric: str = "cosine") -> DataFrame:
    """The k artifacts nearest to a text: neighbor_id, score, rank."""
    spark, kind = corpus.sparkSession, dict(corpus.dtypes)["artifact_id"]
    vector = [float(x) for x in np.asarray(model.encode([text]))[0]]
    query = spark.createDataFrame([(None, vector)], f"artifact_id {kind}, embedding array<double>")
    return top_k(query, corpus, k, metric, exclude_self=False).drop("query_id")


def cluster_summary(clustered: DataFrame, segments: DataFrame, id_col: str) -> DataFrame:
    """Each cluster's size, speakers, total and mean duration."""
    on = clustered.select("artifact_id", "cluster").join(segments, F.col("artifact_id") == F.col(id_col))
    return on.groupBy("cluster").agg(F.count(F.lit(1)).alias("segments"), F.count_distinct("speaker").alias("speakers"), F.sum("duration").alias("total_duration"), F.avg("duration").alias("avg_duration"))
