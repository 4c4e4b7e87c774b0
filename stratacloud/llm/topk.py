"""Exact top-k by integer inner product: term-at-a-time accumulation over blocks.

A vector component is a weighted term. A block of candidates is turned into postings (term: positions, weights); each
query row scatters weight times postings into a dense score array for the block, one term after another; the best k of
the array are selected by partition, and blocks are merged by a window over k rows per query and block.

Queries and candidates are cut into blocks of bounded size; each (query block, candidate block) pair is one task's group, so
neither side is broadcast or collected, and no pair row is made. The work is queries times candidates, which exactness asks
for; a candidate is sent once for each QUERY_BLOCK queries, a query once for each candidate block. Candidates are cut finer
where there are fewer blocks than tasks.

Vectors that are null, or hold null or non-finite components, and rows without an id take no part. Vectors of different lengths
are scored over the components they share. Ties go to the smaller id. A query's candidates are all rows but its own: rows that
repeat an id are separate candidates and, with equal vectors too, copies that find each other; each such row is answered. An
empty table gives an empty result. Columns other than vec_id and embedding are not read, but by is_query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches, task_count

#: Rows of a block of queries and of candidates at most (tens of MB in a task), and of candidates at least.
QUERY_BLOCK, CANDIDATE_BLOCK, LEAST_BLOCK = 16384, 32768, 1024
#: Query rows and candidates whose scores are accumulated at once: they stay in a core's cache.
ROWS, TILE = 16, 4096


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a long; null if the vector is null or holds null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def dense(rows) -> np.ndarray:
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores (queries, candidates), term at a time through the candidates' postings."""
    scores, add = (np.zeros((len(queries), len(candidates)), np.int64) for _ in range(2))
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights, posted = queries[:, term], candidates[:, term]
        if weights.all() and posted.all():
            np.multiply(weights[:, None], posted[None, :], out=add)
            scores += add
            continue
        rows, places = np.flatnonzero(weights), np.flatnonzero(posted)
        if len(rows) and len(places):
            scores[np.ix_(rows, places)] += weights[rows][:, None] * posted[places][None, :]
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest of one query's scores, ties by ids."""
    places = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        over, tied = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        if len(tied) > k - len(over):
            tied = tied[np.argpartition(ids[tied], k - len(over) - 1)[: k - len(over)]]
        places = np.concatenate([over, tied])
    return places[np.lexsort((ids[places], -scores[places]))]


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """vectors(vec_id, embedding): query_id, rank, vec_id, score of each query's k best candidates."""
    small_batches(vectors.sparkSession)
    q = vectors.select(F.col("vec_id").alias("vec_id"), quantise(F.col("embedding"), scale).alias("terms"), is_query.alias("is_query")).filter("terms is not null and vec_id is not null")
    tasks = task_count(vectors.sparkSession, vectors)
    counts = q.agg(F.count("*").alias("n"), F.count_if("is_query").alias("m")).first()
    query_blocks = -(-counts.m // QUERY_BLOCK) or 1
    candidate_blocks = max(-(-counts.n // CANDIDATE_BLOCK), min(-(-tasks // query_blocks), -(-counts.n // LEAST_BLOCK))) or 1
    block = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), F.col("vec_id"), F.col("terms")), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # equal rows are one query with so many copies; equal rows are in one candidate block, too
    queries = q.filter("is_query").groupBy("vec_id", "terms").agg(F.count("*").alias("copies"))
    left = queries.select("vec_id", "terms", "copies", block(1, query_blocks).alias("qb"), block(2, candidate_blocks).alias("own"), spread(candidate_blocks).alias("cb"))
    right = q.select("vec_id", "terms", block(2, candidate_blocks).alias("cb"), spread(query_blocks).alias("qb"))
    dealt = [side.repartition(max(tasks, query_blocks * candidate_blocks), "qb", "cb") for side in (left, right)]

    def score(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(queries) and len(candidates):
            asked, ids = queries["vec_id"].to_numpy(), candidates["vec_id"].to_numpy()
            a, b = dense(list(queries["terms"])), dense(list(candidates["terms"]))
            near = (queries["own"] == queries["cb"]).to_numpy()
            for i in range(0, len(a), ROWS):
                for j in range(0, len(b), TILE):
                    s, here = accumulate(a[i : i + ROWS], b[j : j + TILE]), ids[j : j + TILE]
                    for row in range(len(s)):
                        # one place more, since the query's own row is left out below
                        for p in best(s[row], here, k + 1):
                            mine = bool(near[i + row] and here[p] == asked[i + row] and list(queries["terms"].iloc[i + row]) == list(candidates["terms"].iloc[j + p]))
                            found.append((i + row, here[p], s[row, p], mine))
        out = pd.DataFrame(found, columns=["q", "vec_id", "score", "mine"])
        out = out[~(out["mine"].astype(bool) & ~out.duplicated(["q", "mine"]))]
        out = out.sort_values(["q", "score", "vec_id"], ascending=[True, False, True]).groupby("q").head(k)
        places = out["q"].to_numpy(np.int64)
        return pd.DataFrame({"query_id": queries["vec_id"].to_numpy(np.int64)[places], "one": queries["one"].to_numpy(np.int64)[places], "two": queries["two"].to_numpy(np.int64)[places], "copies": queries["copies"].to_numpy(np.int64)[places], "vec_id": out["vec_id"].astype("int64"), "score": out["score"].astype("int64")})

    found = dealt[0].withColumns({"one": F.xxhash64("terms"), "two": F.xxhash64(F.lit(2), "terms")}).groupBy("qb", "cb").cogroup(dealt[1].groupBy("qb", "cb"))
    found = found.applyInPandas(score, "query_id bigint, one bigint, two bigint, copies bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "one", "two").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("query_id", "rank", "vec_id", "score")
